"""Dirty values, delimited lists, minute boundaries, line ids, labels."""

import datetime as dt

import pytest
from decimal import Decimal

from pyspark.sql import functions as F

from casebook.functions import minutes_between, parse_measure, split_list, null_tokens, iso_weekday
from casebook.operators import cleaning as CL
from conftest import rows


def test_parse_measure_unit_forms(spark):
    df = spark.createDataFrame([(s,) for s in ["20km", "23.4 km", "13.4km", "10", "25km", "null", "", " ", None, "n/a"]],
                               "s string")
    got = [r[0] for r in df.select(parse_measure("s", "decimal(10,2)")).collect()]
    assert got == [Decimal("20.00"), Decimal("23.40"), Decimal("13.40"), Decimal("10.00"), Decimal("25.00"),
                   None, None, None, None, None]
    dur = spark.createDataFrame([(s,) for s in ["32 minutes", "25mins", "15 minute", "40", "10minutes", "null"]], "s string")
    assert [r[0] for r in dur.select(parse_measure("s", "int")).collect()] == [32, 25, 15, 40, 10, None]


def test_null_tokens(spark):
    df = spark.createDataFrame([("null",), ("",), ("NULL",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(null_tokens("s")).collect()] == [None, None, None, "x", None]


def test_split_list_forms(spark):
    df = spark.createDataFrame([(s,) for s in ["4", "1, 5", "11,2", "1, 1", "x", "null", "", None, "2, 6"]], "s string")
    got = [r[0] for r in df.select(split_list("s")).collect()]
    assert got == [[4], [1, 5], [11, 2], [1, 1], [], None, None, None, [2, 6]]


def test_explode_list_matches_cross_apply(spark):
    df = spark.createDataFrame([(1, "1, 5"), (2, None), (3, "11,2"), (4, "null")], "id int, s string")
    out = CL.explode_list(df, "s", keep=["id"], out="v")
    assert rows(out) == [(1, 1), (1, 5), (3, 2), (3, 11)]


def test_minute_boundaries(spark):
    T = dt.datetime
    df = spark.createDataFrame([(T(2020, 1, 1, 18, 5, 58), T(2020, 1, 1, 18, 6, 2)),
                                (T(2020, 1, 1, 18, 5, 2), T(2020, 1, 1, 18, 15, 1)),
                                (T(2020, 1, 1, 23, 59, 0), T(2020, 1, 2, 0, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(minutes_between("a", "b")).collect()] == [1, 10, 2]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_minutes_across_a_clock_change(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(dt.datetime(2001, 4, 1, 2, 58), dt.datetime(2001, 4, 1, 3, 3))], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(minutes_between("a", "b")).first()[0] == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso_weekday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert [r[0] for r in df.select(iso_weekday("d")).collect()] == [1, 7]


def test_row_id_stable_and_per_partition(spark):
    df = spark.createDataFrame([(4, "4", ""), (4, "4", ""), (4, "4", "1"), (3, "", None)], "order_id int, ex string, xt string")
    a = rows(CL.with_row_id(df, "order_id"), "order_id", "line_id", "ex", "xt")
    b = rows(CL.with_row_id(df.repartition(3), "order_id"), "order_id", "line_id", "ex", "xt")
    assert a == b
    assert sorted((o, l) for o, l, _, _ in a) == [(3, 1), (4, 1), (4, 2), (4, 3)]


def test_decode_list_both_paths(spark):
    lines = spark.createDataFrame([(1, [4, 1]), (2, []), (3, None), (4, [2, 2])], "k int, ids array<int>")
    dic = [(1, "Bacon"), (2, "BBQ Sauce"), (4, "Cheese")]
    by_map = CL.decode_list(lines, "k", "ids", dic, out="t")
    assert rows(by_map) == sorted([(1, "Bacon, Cheese"), (2, None), (3, None), (4, "BBQ Sauce, BBQ Sauce")],
                                  key=lambda r: r[0])
    dict_df = spark.createDataFrame(dic, "topping_id int, topping_name string")
    by_join = CL.decode_list(lines, "k", "ids", dict_df, out="t")
    assert rows(by_join) == [(1, "Bacon, Cheese"), (4, "BBQ Sauce, BBQ Sauce")]


def test_clean_runner_orders(spark):
    raw = spark.createDataFrame([
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (6, 3, "null", "null", "null", "Restaurant Cancellation"),
        (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
        (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", None),
    ], "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    out = CL.clean_runner_orders(raw)
    got = rows(out, "order_id", "pickup_time", "distance", "duration", "cancellation")
    assert got[0] == (1, dt.datetime(2020, 1, 1, 18, 15, 34), Decimal("20.00"), 32, None)
    assert got[1] == (6, None, None, None, "Restaurant Cancellation")
    assert got[3] == (8, dt.datetime(2020, 1, 10, 0, 15, 2), Decimal("23.40"), 15, None)


def test_row_id_split_equals_plain(spark):
    from casebook.sources import adapters as A
    from conftest import SF_SMALL
    raw = A.customer_orders_raw(spark, SF_SMALL)
    # one order holding many lines, with NULLs in the split columns
    hot = raw.select(F.lit(-1).cast("bigint").alias("order_id"), F.lit(None).cast("bigint").alias("customer_id"),
                     "pizza_id", "exclusions", "extras", "order_time")
    df = raw.unionByName(hot)
    from collections import Counter
    plain = Counter(tuple(r) for r in CL.with_row_id(df, "order_id").collect())
    split = Counter(tuple(r) for r in CL.with_row_id(df, "order_id", split_prefix=3).select(*df.columns, "line_id").collect())
    assert plain == split


def test_session_settings_do_not_change_results(spark):
    """Wall-clock parsing ignores the session time zone (even inside a daylight-saving
    gap), and a NULL list has size 0 with ANSI mode off too (where size(NULL) = -1)."""
    from casebook.functions import parse_timestamp, list_size
    df = spark.createDataFrame([("2000-04-02 02:42:25", None), ("2020-01-01 18:05:58", [1, 2])], "s string, l array<int>")
    old_tz, old_ansi = spark.conf.get("spark.sql.session.timeZone"), spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        got = df.select(parse_timestamp("s").alias("t"), list_size("l").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)
    assert [(r.t, r.n) for r in got] == [(dt.datetime(2000, 4, 2, 2, 42, 25), 0), (dt.datetime(2020, 1, 1, 18, 5, 58), 2)]
