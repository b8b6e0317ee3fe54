"""Pieces of packing against the tokenizer library, its bound against the plain form."""

import random
import time
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from casebook.llm import packing
from casebook.llm.queries import PACKING_TOKENIZER


def brute_pieces(rows, capacity=packing.CAPACITY):
    tok = Tokenizer.from_file(PACKING_TOKENIZER)
    out = []
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start:start + capacity], "<u4")
            out.append((doc_id, k, start, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def pieces(df):
    return sorted(map(tuple, packing.cut_pieces(df, PACKING_TOKENIZER).collect()), key=str)


def test_pieces_are_the_library_s(spark, monkeypatch):
    """Special strings inside texts and words, odd spaces, marks, long texts, repeats."""
    monkeypatch.setattr(packing, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(packing, "WORDS_HELD", 40)  # given up again and again
    texts = [None, "", " ", "a <|endoftext|> b", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "it's we'll 12 345 é é ́x ÀÉÎ ΣΑΣ ß  nb sp", "\x0b\x0c\x1c\x1d a\x85b", "日本語 テキスト", "😀😀 👩‍👩‍👧",
             "word " * 9000, "x" * 20_000, "<|endoftext|>" * 5000]
    rng = random.Random(6)
    texts += [" ".join(rng.choice(["alpha", "beta,", "don't", "42", "<|endoftext|>", "Ωmega", f"w{rng.randrange(300)}"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, "same"), (7, "same"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, piece int")
    assert pieces(df) == brute_pieces(rows)
    assert pieces(df.limit(0)) == []


def test_pieces_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert pieces(docs) == brute_pieces([tuple(r) for r in docs.collect()])


def plain_bound(histogram, capacity):
    items = [s for s, n in histogram.items() for _ in range(n)]
    best = -(-sum(items) // capacity)
    for k in {s for s in items if s <= capacity // 2}:
        big = sum(s > capacity - k for s in items)
        mid = [s for s in items if capacity // 2 < s <= capacity - k]
        small = sum(s for s in items if k <= s <= capacity // 2)
        best = max(best, big + len(mid) + max(0, -(-(small - (capacity * len(mid) - sum(mid))) // capacity)))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_bound_by_prefix_sums(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 31, 100])
    histogram = {rng.randint(1, capacity): rng.randint(1, 5) for _ in range(rng.randint(1, 20))}
    assert packing.lower_bound(histogram, capacity) == plain_bound(histogram, capacity)


def test_search_of_many_lengths_is_quick():
    """Thousands of distinct lengths and a gap the search can't close: all nodes are used."""
    rng = random.Random(8)
    histogram = {}
    for _ in range(20_000):
        s = min(4096, int(rng.lognormvariate(7.2, .6)) + 1)
        histogram[s] = histogram.get(s, 0) + 1
    began = time.time()
    fillings = packing.bin_completion(histogram)
    assert time.time() - began < 60
    packed = {}
    for f in fillings:
        assert sum(s * k for s, k in f.items) <= 4096
        for s, k in f.items:
            packed[s] = packed.get(s, 0) + k * f.count
    assert packed == histogram
