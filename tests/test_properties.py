"""Property tests: list and measure parsing against plain-Python reference parsers on
random dirty strings (one DataFrame per generated batch)."""

import re
from decimal import Decimal, ROUND_HALF_UP

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from casebook.functions import parse_measure, split_list

TOKEN = st.one_of(st.integers(0, 99).map(str), st.sampled_from(["x", "", " ", "null", "1.5", "-3"]))
LIST_TEXT = st.one_of(
    st.lists(st.tuples(TOKEN, st.sampled_from([",", ", ", " ,"])), max_size=5).map(
        lambda parts: "".join(t + sep for t, sep in parts).rstrip(", ")),
    st.sampled_from(["null", "", "NULL", " "]), st.none())


def py_split(s):
    if s is None or s.strip().lower() in ("null", ""):
        return None
    out = []
    for part in s.split(","):
        p = part.strip()
        if re.fullmatch(r"[+-]?\d+", p):
            out.append(int(p))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LIST_TEXT, min_size=1, max_size=30))
def test_split_list_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(split_list("s")).collect()]
    assert got == [py_split(t) for t in texts]


NUMBER = st.decimals(min_value=0, max_value=9999, places=2,
                     allow_nan=False, allow_infinity=False)
UNIT = st.sampled_from(["", "km", " km", "km ", " minutes", "mins", " minute", "minutes"])
MEASURE = st.one_of(st.tuples(NUMBER, UNIT).map(lambda p: f"{p[0]}{p[1]}"),
                    st.sampled_from(["null", "", "n/a", " ", "abc"]), st.none())


def py_measure(s):
    if s is None or s.strip().lower() in ("null", ""):
        return None
    m = re.match(r"^\s*(-?[0-9]+(\.[0-9]+)?)", s)
    if not m:
        return None
    return Decimal(m.group(1)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(MEASURE, min_size=1, max_size=30))
def test_parse_measure_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_measure("s", "decimal(10,2)")).collect()]
    assert got == [py_measure(t) for t in texts]
