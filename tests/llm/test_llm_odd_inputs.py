"""Scores against brute force; empty tables, very long texts and repeated rows."""

import math
import random
from collections import Counter

import pytest
import regex
from test_llm_dedup import brute_components, brute_repeats
from test_llm_filters import COUNTS, brute_base

import corpus_pipeline
from casebook.llm import jaccard, pii, quality, suffix_dedup


def brute_llr(rows, good):
    grams = {}
    for i, text in rows:
        tokens = regex.findall(quality.TOKEN, text or "")
        grams[i] = tokens + list(zip(tokens, tokens[1:]))
    raw = Counter(g for own in grams.values() for g in own)
    target = Counter(g for i, own in grams.items() if i in good for g in own)
    p = lambda counts, g: math.log((counts[g] + 1) / (sum(counts.values()) + len(raw)))
    ratio = {g: math.floor(1000 * (p(target, g) - p(raw, g)) + 0.5) for g in raw}
    return {i: sum(ratio[g] for g in own) / (1000 * len(own)) if own else 0.0 for i, own in grams.items()}


def test_quality_scores_equal_brute_force(spark):
    rng = random.Random(8)
    plain, odd = [f"w{i}" for i in range(40)], [f"buy{i}!" for i in range(15)]
    rows = [(0, None), (1, ""), (2, "!")]
    rows += [(10 + i, " ".join(rng.choice(plain if i % 3 else odd + plain[:5]) for _ in range(rng.randint(1, 60)))) for i in range(90)]
    rows += [(200, rows[20][1]), (201, rows[20][1])]  # texts alike are counted each time
    good = {i for i, _ in rows if i >= 10 and i % 3 == 2}
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, gram int")
    labels = spark.createDataFrame([(i, 1, 0) for i in good], "doc_id long, quality int, toxic int")
    got = quality.judge_quality(df, labels, threshold=-0.1).collect()
    want = brute_llr(rows, good)
    assert {r.doc_id: round(r.llr, 9) for r in got} == {i: round(x, 9) for i, x in want.items()}
    assert {r.doc_id: r.kept for r in got} == {i: not brute_base(t)[-1] and want[i] >= -0.1 for i, t in rows}
    assert {r.kept for r in got} == {True, False}


def test_long_texts_and_repeated_rows(spark):
    rng = random.Random(3)
    long = " ".join(f"word{rng.randrange(5000)}" for _ in range(60_000))
    mail = "mail to ann@example.org or +49 30 1234567. "
    rows = [(1, long), (2, long.replace("word7 ", "other ", 1)), (3, mail * 3000), (3, mail * 3000), (4, "x" * 300_000), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_components(df, 4, 85).drop("t").collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 4, 85)
    got = quality.judge_quality(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).select("doc_id", *COUNTS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *brute_base(t))) for i, t in rows)
    got = {(r.doc_id, r.n_email, r.n_phone) for r in pii.find_personal_data(df, pii.train(df)).collect()}
    assert got == {(1, 0, 0), (2, 0, 0), (3, 3000, 3000), (4, 0, 0), (5, 0, 0)}
    few = [(1, long[:100_000]), (2, long[50_000:150_000]), (3, mail * 40), (3, mail * 40), (4, "x" * 30_000)]
    got = suffix_dedup.digests(spark.createDataFrame(few, "doc_id long, text string")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(few, 200)


@pytest.mark.parametrize("find", [suffix_dedup.digests, lambda d: pii.find_personal_data(d, pii.train(d))])
def test_empty_table(spark, find):
    assert find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_empty_table_in_the_pipeline_s_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0, name
