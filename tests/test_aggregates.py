"""Grouped measures: empty groups kept, shares, pivots, buckets, activity rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook.operators import aggregates as AG
from casebook.operators import ledger as LE
from conftest import rows

D = dt.date


@pytest.fixture(scope="module")
def nodes(spark):
    regions = spark.createDataFrame([(1, "Africa"), (2, "Europe"), (3, "Empty")], "region_id int, region_name string")
    facts = spark.createDataFrame([
        (10, 1, 1, D(2020, 1, 1), D(2020, 1, 11)), (10, 1, 2, D(2020, 1, 11), D(2020, 1, 31)),
        (11, 1, 2, D(2020, 1, 1), D(9999, 12, 31)), (12, 2, 5, D(2020, 1, 1), D(2020, 1, 1)),
    ], "customer_id int, region_id int, node_id int, start_date date, end_date date")
    return regions, facts


def test_distinct_per_group_keeps_empty(nodes):
    regions, facts = nodes
    out = AG.distinct_per_group(regions, facts, "region_id", "region_name",
                                {"n_nodes": "node_id", "n_customers": "customer_id"})
    assert rows(out) == [("Africa", 2, 2), ("Empty", 0, 0), ("Europe", 1, 1)]


def test_interval_stats_groups_kept(nodes):
    regions, facts = nodes
    j = facts.join(regions, "region_id")
    out = {r.region_name: r for r in LE.interval_stats(j, "start_date", "end_date", by="region_name",
                                                       groups=regions).collect()}
    assert out["Empty"].avg_days is None and out["Europe"].p50_days == 0.0
    assert out["Africa"].avg_days == 15.0  # open interval left out


def test_share_of_total(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], "k int, v string")
    within = rows(AG.share_of_total(df, F.col("v") == "a", by="k"), "k", "n", "total", "pct")
    assert within == [(1, 1, 2, 50.0), (2, 1, 1, 100.0), (3, 0, 1, 0.0)]
    overall = rows(AG.share_of_total(df, F.lit(True), by="v", within="all"), "v", "n", "total", "pct")
    assert overall == [("a", 2, 4, 50.0), ("b", 1, 4, 25.0), ("c", 1, 4, 25.0)]
    dist = AG.share_of_total(df, F.col("v") == "a", distinct="k").collect()[0]
    assert (dist.n, dist.total, dist.pct) == (2, 3, 66.7)


def test_pivot_and_top_global_ties(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1)], "c int, p int")
    assert rows(AG.pivot_counts(df, "c", "p", [1, 2, 3], "n_")) == [(1, 1, 2, 0), (2, 1, 0, 0)]
    ties = AG.top_k_items(df.union(df.filter("p = 1")), "p", k=1, ties="all", count_name="n")
    assert rows(ties) == [(1, 4)]
    ties2 = AG.top_k_items(df, "p", k=1, ties="all", count_name="n")
    assert rows(ties2) == [(1, 2), (2, 2)]


def test_bucketize_labels(spark):
    df = spark.createDataFrame([(0,), (30,), (31,), (60,), (200,)], "days int")
    got = rows(AG.bucketize(df, "days", 30), "days", "bucket", "label")
    assert got == [(0, 1, "0-30 days"), (30, 1, "0-30 days"), (31, 2, "31-60 days"), (60, 2, "31-60 days"),
                   (200, 7, "181-210 days")]
    capped = dict(rows(AG.bucketize(df, "days", 30, cap=180), "days", "label"))
    assert capped[200] == "180+ days"


def test_activity_and_entity_average(spark):
    t = spark.createDataFrame([
        (1, "2020-01", "deposit", 10), (1, "2020-01", "deposit", 20), (1, "2020-01", "purchase", 5),
        (2, "2020-01", "deposit", 10), (2, "2020-01", "withdrawal", 1),
        (3, "2020-02", "deposit", 1), (3, "2020-02", "deposit", 1), (3, "2020-02", "withdrawal", 1),
    ], "customer_id int, month string, txn_type string, txn_amount int")
    act = rows(AG.activity_rule(t, "customer_id", F.col("month"), "txn_type",
                                {"deposit": (["deposit"], 2), "purchase": (["purchase"], 1),
                                 "withdrawal": (["withdrawal"], 1)}), "month", "n_customers")
    assert act == [("2020-01", 1), ("2020-02", 1)]
    avg = AG.per_entity_average(t, "customer_id", F.col("txn_type") == "deposit", "txn_amount").collect()[0]
    assert avg.avg_count == pytest.approx(5 / 3) and avg.avg_amount == pytest.approx(42 / 3)


def test_change_flags_null_lists(spark):
    df = spark.createDataFrame([(1, None, None), (1, [1], None), (1, [1], [2]), (1, [], [])],
                               "c int, ex array<int>, xt array<int>")
    r = AG.change_flags(df, "c", ["ex", "xt"]).collect()[0]
    assert (r.n_changed, r.n_unchanged, r.n_both_changed) == (2, 2, 1)


def test_duration_buckets_and_rates(spark):
    T = dt.datetime
    df = spark.createDataFrame([
        ("r1", T(2020, 1, 1, 10, 0, 59), T(2020, 1, 1, 10, 1, 0), D(2020, 1, 1), D(2020, 1, 31), 10.0, 20),
        ("r1", T(2020, 1, 1, 10, 0, 0), T(2020, 1, 1, 10, 30, 0), D(2021, 6, 1), D(2021, 6, 2), 5.0, 0),
        ("r2", T(2020, 1, 2, 23, 0, 0), None, D(2021, 6, 1), D(2021, 6, 1), 6.0, 30),
    ], "r string, a timestamp_ntz, b timestamp_ntz, s date, e date, km double, mins int")
    mins = {r.r: r for r in AG.duration_stats(df, "a", "b", "minute", by="r").collect()}
    assert (mins["r1"].min, mins["r1"].max, mins["r1"].range) == (1, 30, 29)
    assert mins["r2"].avg is None  # no end time: ignored
    days = AG.duration_stats(df, "s", "e", "day", prefix="d_").collect()[0]
    assert (days.d_min, days.d_max) == (0, 30)
    by_year = rows(AG.time_bucket_counts(df, "s", "year"), "year", "n")
    assert by_year == [(2020, 1), (2021, 2)]
    by_date = rows(AG.time_bucket_counts(df, "a", "date", distinct="r"), "date", "n")
    assert by_date == [(D(2020, 1, 1), 1), (D(2020, 1, 2), 1)]
    rate = dict(rows(AG.rate_stats(df, "km", "mins", by="r", scale=60.0, name="kmh"), "r", "kmh"))
    assert rate["r1"] == pytest.approx(30.0) and rate["r2"] == pytest.approx(12.0)  # zero duration ignored
