"""State transitions: equivalent formulations agree; hand-checked paths."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebook.operators import sequence as SQ
from casebook.sources import adapters as A
from conftest import rows, SF_SMALL

D = dt.date


@pytest.fixture(scope="module")
def paths(spark):
    # 1: 0->1->2->3->4 ; 2: 0->3->4 ; 3: only 0 ; 4: 0->4 ; 5: 0->2->1 (downgrade) ; 6: two changes on one day
    return spark.createDataFrame([
        (1, 0, D(2020, 1, 1), 1), (1, 1, D(2020, 1, 8), 2), (1, 2, D(2020, 2, 8), 3), (1, 3, D(2020, 3, 8), 4),
        (1, 4, D(2020, 6, 1), 5),
        (2, 0, D(2020, 1, 1), 6), (2, 3, D(2020, 1, 8), 7), (2, 4, D(2020, 9, 1), 8),
        (3, 0, D(2020, 1, 1), 9),
        (4, 0, D(2020, 1, 1), 10), (4, 4, D(2020, 1, 8), 11),
        (5, 0, D(2020, 1, 1), 12), (5, 2, D(2020, 1, 8), 13), (5, 1, D(2020, 5, 8), 14),
        (6, 0, D(2020, 1, 1), 15), (6, 1, D(2020, 1, 8), 16), (6, 4, D(2020, 1, 8), 17),
    ], "customer_id int, plan_id int, start_date date, sub_seq int")


def test_reached_only_forms_agree(paths, spark):
    a = rows(SQ.reached_only(paths, "customer_id", "plan_id", 4, [1, 2, 3]))
    b = rows(SQ.reached_only_joins(paths, "customer_id", "plan_id", 4, [1, 2, 3]))
    assert a == b == [(4,)]
    subs = A.subscriptions(spark, SF_SMALL)
    assert rows(SQ.reached_only(subs, "customer_id", "plan_id", 4, [1, 2, 3])) == \
        rows(SQ.reached_only_joins(subs, "customer_id", "plan_id", 4, [1, 2, 3]))
    share = SQ.reached_only_share(paths, "customer_id", "plan_id", 4, [1, 2, 3]).collect()[0]
    assert (share.n_only, share.n_reached) == (1, 4)


def test_transitions_with_same_day_tiebreak(paths):
    t = SQ.plan_transitions(paths, "customer_id", "start_date", "plan_id", "sub_seq")
    c6 = rows(t.filter("customer_id = 6"), "sub_seq", "prev_plan_id", "next_plan_id")
    assert c6 == [(15, None, 1), (16, 0, 4), (17, 1, None)]
    down = SQ.count_transitions(paths, "customer_id", "start_date", "plan_id", 2, 1, "sub_seq", year=2020).collect()[0][0]
    assert down == 1


def test_state_as_of_and_time_between(paths):
    cur = dict(rows(SQ.state_as_of(paths, "customer_id", "start_date", "plan_id", "2020-02-08", tiebreak="sub_seq")))
    assert cur == {1: 2, 2: 3, 3: 0, 4: 4, 5: 2, 6: 4}
    strict = dict(rows(SQ.state_as_of(paths, "customer_id", "start_date", "plan_id", "2020-02-08", inclusive=False,
                                      tiebreak="sub_seq")))
    assert strict[1] == 1
    days = dict(rows(SQ.time_between_states(paths, "customer_id", "start_date", "plan_id", 0, 3)))
    assert days == {1: 67, 2: 7}


@pytest.mark.parametrize("unit", ["month", "year"])
def test_bucketed_shift_equals_plain(spark, paths, unit):
    """The hot-key split (per-bucket windows + edge fix-up) gives the plain window's
    answer, including ties on the date and empty buckets."""
    subs = A.subscriptions(spark, SF_SMALL).unionByName(paths.select(
        F.col("customer_id").cast("bigint"), "plan_id", "start_date", F.col("sub_seq").cast("bigint")))
    cols = ["customer_id", "sub_seq", "prev_plan_id", "prev_start_date", "next_plan_id", "next_start_date"]
    plain = SQ.plan_transitions(subs, "customer_id", "start_date", "plan_id", "sub_seq")
    split = SQ.plan_transitions(subs, "customer_id", "start_date", "plan_id", "sub_seq",
                                bucket=F.trunc("start_date", unit))
    assert rows(plain, *cols) == rows(split, *cols)


def test_ledger_bucketed_equals_plain(spark):
    from casebook.operators import billing as BI
    subs = A.subscriptions(spark, SF_SMALL)
    a = BI.billing_ledger(subs, A.plans(spark), "2001-12-31")
    b = BI.billing_ledger(subs, A.plans(spark), "2001-12-31", bucket=F.trunc("start_date", "month"))
    assert rows(a) == rows(b)


def test_hot_customer_is_split_across_tasks(spark):
    """One customer holding most rows: the bucketed shift processes its rows in many
    window partitions, the plain shift in one."""
    n = 20000
    hot = spark.range(n).select(F.lit(1).cast("bigint").alias("customer_id"),
                                (F.col("id") % 5).cast("int").alias("plan_id"),
                                F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") / 4).cast("int")).alias("start_date"),
                                F.col("id").alias("sub_seq"))
    cold = spark.range(n // 2).select((F.col("id") % 500 + 2).alias("customer_id"), F.lit(1).alias("plan_id"),
                                      F.date_add(F.lit("2015-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("start_date"),
                                      (F.col("id") + n).alias("sub_seq"))
    subs = hot.unionByName(cold)
    def tasks_for_hot(df):
        # partition id taken before the filter (a nondeterministic column stops the
        # filter from being pushed below the window); the shifted column is used so
        # the window is not pruned away
        # (collect, not count: count would let Catalyst prune the window again)
        return len(df.withColumn("p", F.spark_partition_id()).filter("customer_id = 1")
                     .groupBy("p").agg(F.max("next_plan_id")).collect())
    plain = SQ.plan_transitions(subs, "customer_id", "start_date", "plan_id", "sub_seq")
    split = SQ.plan_transitions(subs, "customer_id", "start_date", "plan_id", "sub_seq",
                                bucket=F.trunc("start_date", "month"))
    # at test size AQE would coalesce every shuffle into one partition; switch that
    # off to see the partitioning the plan asks for
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tasks_for_hot(plain) == 1
        assert tasks_for_hot(split) >= 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    cols = ["customer_id", "sub_seq", "prev_plan_id", "next_plan_id", "next_start_date"]
    assert rows(plain, *cols) == rows(split, *cols)


def test_all_ties_of_a_hot_first_day(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date").alias("d"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tied = SQ.first_last_by(df, "k", "d", "v", ties="all")
        sizes = sorted(r["count"] for r in tied.where("k = 7").groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 20_000 and len(sizes) >= 4 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_all_ties_with_nulls(spark):
    data = [(None, 1, "a"), (None, 1, "b"), (None, 2, "c"), (1, None, "d"), (1, None, "d"), (1, 5, "e"), (2, 3, None), (2, 3, "f"), (2, 4, "g")]
    df = spark.createDataFrame(data, "k int, o int, v string")
    first = sorted(map(tuple, SQ.first_last_by(df, "k", "o", "v", ties="all").collect()), key=str)
    last = sorted(map(tuple, SQ.first_last_by(df, "k", "o", "v", which="last", ties="all").collect()), key=str)
    assert first == sorted([(None, 1, "a"), (None, 1, "b"), (1, None, "d"), (2, 3, None), (2, 3, "f")], key=str)
    assert last == sorted([(None, 2, "c"), (1, 5, "e"), (2, 4, "g")], key=str)
