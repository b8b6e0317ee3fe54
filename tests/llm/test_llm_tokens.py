"""Byte-level BPE and packing."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from conftest import SF_SMALL

from casebook.llm import bpe, packing
from casebook.llm.common import blocks, stage
from casebook.llm.queries import PACKING_TOKENIZER, QUERIES

RANKS = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "b", "é", "'s", "'", "1", "!", "\u00a0", "\x1f", "Z"]
    return [None, "", "  ", " a", "a  b", "a \n b", "\n\n x", "it's  we'll\t\tgo", "é ü\u00a0 ñ\u3000x", "a" * 3000, "ab " * 2000 + " ", "x\x1c y", "😀 😀😀"] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(500)]


def test_merge_equals_library():
    rng = random.Random(1)
    for _ in range(500):
        word = "".join(rng.choice("abcdeé\u4e2d tion") for _ in range(rng.randint(1, 40)))
        assert bpe.merge(word.encode(), RANKS) == ENC._core_bpe.encode_single_piece(word.encode())


def test_encode_and_decode(spark):
    rows = list(enumerate(odd_texts())) + [(None, "null id"), (1, "again"), (1, "again")]
    # a clashing extra column is left alone
    df = stage(spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, ids int").repartition(3), "test")
    got = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS).collect()
    want = sorted((str(i), tuple(ENC.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), tuple(r.ids), bytes(r.decoded)) for r in got) == want
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).collect() == []


def test_blocks_do_not_depend_on_batches():
    rng = random.Random(5)
    for target in (1, 20, 100):
        texts = ["x" * rng.choice([0, 0, 1, 7, 20, 30, 150]) for _ in range(400)]
        whole = pa.table({"text": texts})
        cuts = {n: [t.column("text").to_pylist() for t in blocks(whole.to_batches(n), "text", target)] for n in (1, 3, 64, 67, 400)}
        assert sum(cuts[400], []) == texts
        assert all(len("".join(b)) <= target or len(b) == 1 for b in cuts[400])
        assert all(c == cuts[400] for c in cuts.values())


def test_op1_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d in docs:
        ids = ENC.encode_ordinary(d.text or "")
        want[d.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())
    got = QUERIES["op1_byte_bpe"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def fewest_bins(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + items[i] <= capacity:
                bins[j] += items[i]
                place(i + 1, bins)
                bins[j] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(100))
def test_bin_completion_is_optimal_on_small_sets(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 50, 100])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
    histogram = {s: items.count(s) for s in items}
    fillings = packing.bin_completion(histogram, capacity)
    packed = {}
    for f in fillings:
        assert sum(s * k for s, k in f.items) <= capacity
        for s, k in f.items:
            packed[s] = packed.get(s, 0) + k * f.count
    assert packed == histogram
    assert sum(f.count for f in fillings) == fewest_bins(items, capacity)
    assert packing.lower_bound(histogram, capacity) <= sum(f.count for f in fillings)


def test_search_reaches_leaves_with_many_lengths():
    histogram = {18: 1, 25: 1, 14: 1, 20: 2, 11: 1, 21: 3, 10: 1, 12: 1}
    assert sum(f.count for f in packing.best_fit_decreasing(histogram, 50)) == 5
    # the limit grows with the distinct lengths, so a low one is raised
    assert sum(f.count for f in packing.bin_completion(histogram, 50, node_limit=1)) == 4


def test_pack(spark):
    rows = [(0, None), (1, ""), (None, "no id"), (3, "same"), (3, "same"), (4, "long " * 9000)] + [(10 + i, "a b " * i) for i in range(50)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sequence_id string")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PACKING_TOKENIZER)
    n = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    got = packing.pack(df, PACKING_TOKENIZER).collect()
    assert sum(r.length for r in got) == n
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert len(bins) == -(-n // packing.CAPACITY)
    assert packing.pack(df.limit(0), PACKING_TOKENIZER).collect() == []
