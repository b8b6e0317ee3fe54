"""WARC, exact top-k search, and the pipeline."""

import random

import duckdb
import numpy as np
from conftest import SF_SMALL

import corpus_pipeline
from casebook.llm import jaccard, suffix_dedup, topk, warc
from casebook.llm.common import stage
from casebook.llm.queries import QUERIES


def test_warc(spark):
    tricky = "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" + "é" * 60
    rows = [(1, "u", "x" * 100), (2, "u\r\nEvil: 1", "x" * 100), (3, None, None), (4, "u", ""), (5, "u", tricky), (0, "u", "x" * 100),
            (None, "u", "x" * 100), (6, "u", "x" * 99), (7, "u", "x" * 99), (0, "u", "x" * 100)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, kind string")
    got = warc.round_trip(df).collect()
    kinds = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in got)
    assert sorted(kinds, key=str) == sorted([("0", 100, "response", None), ("0", 100, "revisit", 0), ("1", 100, "revisit", 0), ("2", 100, "revisit", 0), ("None", 100, "revisit", 0),
                                             ("3", 0, "response", None), ("4", 0, "response", None), ("5", len(tricky.encode()), "response", None), ("6", 99, "response", None), ("7", 99, "response", None)], key=str)
    assert warc.round_trip(df.limit(0)).collect() == []


def brute_top(rows, k):
    good = [(i, np.floor(64 * np.array(v, float))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, dim - len(v)))) for i, v in good]
    return sorted((i, rank + 1, j, -s) for i, q in good if i % 20 == 0 for rank, (s, j) in enumerate(sorted((-int(q @ v), j) for j, v in good if j != i)[:k]))


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS_ROWS", 16)
    rng = random.Random(5)
    single = lambda x: float(np.float32(x))
    rows = [(i, [single(rng.uniform(-1, 1)) for _ in range(3)]) for i in range(200)] + [(200 + i, [.5, .5, .5]) for i in range(100)]
    rows += [(1000, None), (1001, [float("nan"), 1., 1.]), (1002, [None, 1., 1.]), (1003, [float("inf"), 0., 0.]), (1020, []), (1040, [1.]), (None, [1., 1., 1.])]
    for some in (rows, rows[:5], []):
        df = spark.createDataFrame([(i, v, 1) for i, v in some], "vec_id long, embedding array<float>, rank int")
        assert sorted(map(tuple, topk.top_k(df).collect())) == brute_top(some, 20)


def test_sql_twins(spark):
    for name, table, sql in (("op5_warc", "pages", warc.SQL), ("op8_exact_top_k", "embeddings", topk.SQL)):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
        res = con.execute(sql)
        df = QUERIES[name](spark, SF_SMALL)
        assert df.columns == [d[0] for d in res.description]
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, res.fetchall()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, SF_SMALL), "test")
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == before
    # odd rows pass through every stage
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, function in corpus_pipeline.STAGES:
        odd = stage(function(spark, odd, SF_SMALL), "test")
    assert odd.count() == 4  # rows without a word are linked with nothing: both of id 1 stay


def test_pipeline_keeps_rows_without_id_and_shingles(spark):
    rows = [(None, None, "a"), (None, "", "b"), (None, "", "b"), (None, " ", "c"), (None, " ", "d"), (1, "", "e"), (1, "", "e"), (2, "p q r s t u", "f"), (3, "p q r s t u", "g")]
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 5, 80)
    assert got.columns == ["doc_id", "text", "lang"]
    assert sorted(r.lang for r in got.collect()) == ["a", "b", "b", "c", "d", "e", "e", "f"]


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the stages' own come through with their values; so do no rows."""
    names = ["d", "t", "row", "d__", "t__", "empty__", "row__", "spans__", "spans___", "id__", "cid", "key", "first"]
    text = "a passage of some words that is long enough to stay as it is " * 6
    rows = [(i, "%d %s" % (i, text), *[f"{n}{i}" for n in names]) for i in (1, 2, 3)] + [(4, None, *names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = jaccard.one_of_each(df, 5, 80)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[3]]
    cut = suffix_dedup.remove_repeats(df)
    assert cut.columns == df.columns and sorted(tuple(r)[2:] for r in cut.collect()) == sorted(r[2:] for r in rows)
    for stage_ in (lambda t: jaccard.one_of_each(t, 5, 80), suffix_dedup.remove_repeats):
        assert stage_(df.limit(0)).collect() == []
