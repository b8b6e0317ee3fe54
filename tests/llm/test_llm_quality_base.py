"""Base rules: windows of every text length against brute force; what their steps carry along."""

import random

from test_llm_filters import COUNTS, brute_base

from casebook.llm import quality

SCHEMA = "doc_id long, text string"


def test_windows_of_short_and_repeating_texts(spark):
    rng = random.Random(11)
    rows = [(n, " ".join(["a"] * n)) for n in range(20)]
    rows += [(20 + n, "".join(rng.choice("abc") + rng.choice([" ", "\t", "\x0b\n", " \r\f "]) for _ in range(n))) for n in range(60)]
    rows += [(100, "  \n a\u00a0b \x1c é "), (101, " ".join(f"w{i % 9}" for i in range(40))), (102, " ".join(map(str, range(30))) * 2), (103, "")]
    got = quality.base_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in got} == {i: brute_base(t) for i, t in rows}


def test_window_steps_leave_the_text_behind(spark):
    base = quality.base_rules(spark.createDataFrame([(1, "a b")], SCHEMA)).drop("text")
    plan = base._jdf.queryExecution().optimizedPlan().toString().splitlines()
    steps = [line for line in plan if "array_distinct(hashes_" in line or "starts_" in line]
    assert steps
    assert not [line for line in steps if "text#" in line or "split_#" in line]
