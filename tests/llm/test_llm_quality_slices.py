"""Quality scores worked through in slices: the same for any number of slices and of
frequent n-grams; what is kept on disk."""

import random
import time
from collections import Counter
from pathlib import Path

import pytest
from test_llm_odd_inputs import brute_llr

from casebook.llm import quality

SCHEMAS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["ü", "--", "$5"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 50))) + f" only{i}") for i in range(60)]
    rows += [(60, rows[7][1]), (61, None), (None, "w1 w2 nobody"), (62, "alone"), (63, "!"), (8, rows[8][1])]
    return rows, {i for i in range(60) if i % 4 == 1} | {62}


@pytest.mark.parametrize("slices, frequent, ids", [(1, 0, 1 << 20), (1, 1 << 19, 0), (4, 0, 0), (3, 20, 1 << 20)])
def test_scores_do_not_depend_on_slices(spark, monkeypatch, slices, frequent, ids):
    monkeypatch.setattr(quality, "SLICES", slices)
    monkeypatch.setattr(quality, "FREQUENT", frequent)
    monkeypatch.setattr(quality, "TRUSTED_BROADCAST", ids)
    rows, good = corpus()
    labels = spark.createDataFrame([(i, 1, 0) for i in good], SCHEMAS[1])
    got = quality.judge_quality(spark.createDataFrame(rows, SCHEMAS[0]), labels, threshold=0.0).collect()
    numbered = [(n, text) for n, (_, text) in enumerate(rows)]
    want = brute_llr(numbered, {n for n, (i, _) in enumerate(rows) if i in good})
    assert Counter((r.doc_id, round(r.llr, 9)) for r in got) == Counter((i, round(want[n], 9)) for n, (i, _) in enumerate(rows))


def test_counts_leave_out_what_is_used_once(spark):
    rows, good = corpus()
    counts, raw, target, distinct = quality.ngram_counts(spark.createDataFrame(rows, SCHEMAS[0]), spark.createDataFrame([(i,) for i in good], "doc_id long"))
    kept = [r for part in counts for r in part.collect()]
    assert min(r.raw for r in kept) == 2
    assert len({r.gram for r in kept}) == len(kept) < distinct
    assert sum(r.raw for r in kept) + distinct - len(kept) == raw > target > sum(r.target for r in kept)


def test_no_shuffle_files_stay(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {p for d in dirs for p in Path(d.getPath()).rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get(quality.DROP_SHUFFLES)
    rows, good = corpus()
    labels = spark.createDataFrame([(i, 1, 0) for i in good], SCHEMAS[1])
    quality.judge_quality(spark.createDataFrame(rows, SCHEMAS[0]), labels, threshold=0.0)
    for _ in range(20):
        if not files() - before:
            break
        time.sleep(0.5)
    assert not files() - before
    assert spark.conf.get(quality.DROP_SHUFFLES) == setting
