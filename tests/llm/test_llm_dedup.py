"""Suffix-array dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL

from casebook.llm import jaccard, suffix_dedup
from casebook.llm.queries import QUERIES


def brute_repeats(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for i, b in data:
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if counts[b[p:p + length]] > 1:
                mask[p:p + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if mask[j] and (j == 0 or not mask[j - 1]))
        out.append((i, len(b), sum(mask), spans, hashlib.sha256(bytes(x for x, m in zip(b, mask) if not m)).hexdigest()))
    return sorted(out, key=str)


def test_suffix_array():
    rng = random.Random(6)
    for _ in range(100):
        b = bytes(rng.choice(b"ab\0c") for _ in range(rng.randint(1, 60)))
        d = np.frombuffer(b, np.uint8)
        assert suffix_dedup.suffix_array(d, suffix_dedup.words_at(d), 200).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def test_suffixes_whose_next_bytes_are_alike_are_not_sorted_again(monkeypatch):
    sorted_again = []
    plain = suffix_dedup.by_group
    monkeypatch.setattr(suffix_dedup, "by_group", lambda group, key: sorted_again.append(len(key)) or plain(group, key))
    rng = random.Random(7)
    copies = [rng.randbytes(1000)] * 30
    d = np.frombuffer(b"".join(copies + [rng.randbytes(300)]), np.uint8)
    hit = suffix_dedup.repeated_windows(d, np.arange(len(d)) <= len(d) - suffix_dedup.LENGTH)
    assert np.flatnonzero(hit).tolist() == list(range(29_801))  # the last copy runs on into other bytes
    assert sum(sorted_again) < len(d)  # 15,000 suffixes stay tied for 24 rounds


def test_order_by_group():
    rng = np.random.default_rng(8)
    for groups in (1, 50, 100_000):
        group, key = np.sort(rng.integers(0, groups, 150_000)), rng.integers(0, 1 << 63, 150_000).astype(np.uint64)
        assert suffix_dedup.by_group(group, key).tolist() == np.lexsort((key, group)).tolist()


@pytest.mark.parametrize("bits", [21, 9])
def test_smallest_hash_of_each_window(monkeypatch, bits):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", bits)
    h = np.random.default_rng(9).integers(0, 60, 3000).astype(np.uint64) << np.uint64(bits)  # many equal
    for n, width in ((3000, 161), (161, 161), (160, 161), (700, 8), (0, 8)):
        own = h[:n].tolist()
        assert suffix_dedup.leftmost_minima(h[:n], width).tolist() == [min(range(i, i + width), key=own.__getitem__) for i in range(n - width + 1)]


@pytest.mark.parametrize("crowd", [20_000, 3])
def test_repeats(spark, monkeypatch, crowd):
    for name, value in (("LENGTH", 20), ("GRAM", 6), ("SORT_BYTES", 500), ("CROWD", crowd)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(6)
    rnd = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [rnd(rng.randint(15, 60)) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "a" * 100), (3, "ab" * 60), (4, "x" * 19), (None, shared[0] + rnd(9)), (7, "same id" + shared[1]), (7, "other " + shared[2])]
    rows += [(10 + i, "".join(rng.choice([rnd(rng.randint(0, 40)), rng.choice(shared)[rng.randint(0, 9):]]) for _ in range(rng.randint(0, 6)))) for i in range(200)]
    rows += [rows[20], rows[21], (500, rows[22][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, t int")
    assert sorted(map(tuple, suffix_dedup.digests(df).collect()), key=str) == brute_repeats(rows, 20)


def test_op2_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op2_suffix_dedup"](spark, SF_SMALL).collect()), key=str) == brute_repeats(rows, 200)


def test_removal_keeps_text_whole():
    data = "aéb".encode()
    assert suffix_dedup.inside_characters(data, [(0, 2)]) == [(0, 1)]
    assert suffix_dedup.inside_characters(data, [(2, 4)]) == [(3, 4)]


def brute_components(rows, n, percent):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for _, t in rows]
    sets = [{tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set() for w in words]
    parent, lists = list(range(len(rows))), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for g in s:
            lists.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in lists[g] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[root(i)] = min(smallest.get(root(i), d), d)
    return sorted(((d, len(s), smallest.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("n, percent", [(4, 85), (2, 60)])
def test_components(spark, n, percent):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 40))] for _ in range(40)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "A b"), (4, "a B"), (None, "x"), (5, "x"), (7, "dup id"), (7, "other text"), (7, "other text")]
    for i in range(300):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((10 + i, " ".join(w)))
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, size int")
    got = jaccard.jaccard_components(df, n, percent).drop("t")
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows, n, percent)


@pytest.mark.parametrize("percent", [85, 70])
def test_long_near_copies(spark, percent, monkeypatch):
    rng = random.Random(9)
    origins = [[f"v{rng.randrange(400)}" for _ in range(rng.randint(60, 200))] for _ in range(3)]
    rows = []
    for i in range(400):
        w = list(origins[0] if i < 300 else rng.choice(origins))
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"own{rng.randrange(2000)}"
        rows.append((i, " ".join(w[rng.randint(0, 8):])))
    tried, write = [], jaccard.stage

    def counted(df, name):
        out = write(df, name)
        tried.extend([out.count()] if name == "join-pairs" else [])
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, percent).drop("t")
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows, 4, percent)
    assert sum(tried) < 40 * len(rows)  # 45,000 pairs share a list


def test_boundary_follows_cost():
    assert jaccard.choose_boundary(1.0, 85) < jaccard.choose_boundary(1000.0, 85) <= jaccard.SMALL


def test_rarity_grows_with_the_text(spark, monkeypatch):
    sizes = [jaccard.cells_for(n) for n in (0, 10**8, 10**9, 10**13)]
    assert sizes == sorted(set(sizes)) and sizes[0] == jaccard.MIN_CELLS and sizes[-1] == jaccard.MAX_CELLS
    assert not any(c % jaccard.CELL_PARTS for c in sizes)
    grades = jaccard.graded(np.arange(1 << 20)).astype(int)
    assert (np.diff(grades) >= 0).all() and (grades[:128] == np.arange(128)).all() and grades.max() < 256
    monkeypatch.setattr(jaccard, "MIN_CELLS", 512)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d e", "b c d e", None, "z"] * 50)], "doc_id long, text string").repartition(5)
    want = np.zeros(512, np.int64)
    for text in ["a b c d e", "b c d e", "z"] * 50:
        _, grams = jaccard.shingle_sets(pa.array([text]), 4)
        np.add.at(want, jaccard._cell(grams, 512), 1)
    assert (jaccard.rarity(df, 4) == jaccard.graded(want)).all()
    empty = jaccard.jaccard_components(df.limit(0), 4, 85)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "t"]


def test_op4_query_and_empty(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op4_jaccard_join"](spark, SF_SMALL).collect()), key=str) == brute_components(rows, 4, 85)
