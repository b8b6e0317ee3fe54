"""Windows over equal ranges of a heavy entity's rows: equal to the plain form, and spread."""

import datetime as dt
import random
from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from casebook.operators import ordered, ranges

DAY = dt.date(2024, 3, 1)


def made(spark, hot_days=1, n=3000):
    """Half of the rows are customer 7's, all within ``hot_days`` days; null customers too."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        k = 7 if i % 2 else rng.choice([None, 1, 2, 3, 4, 5, 6, *range(8, 60)])
        rows.append((k, DAY + dt.timedelta(rng.randrange(hot_days if k == 7 else 400)), i, rng.choice([None, rng.randrange(-50, 90)])))
    return spark.createDataFrame(rows, "customer_id long, day date, seq long, v int"), rows


def tuples(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("hot_days", [1, 300])
def test_neighbours_running_trailing_equal_plain_windows(spark, hot_days):
    df, _ = made(spark, hot_days)
    w = Window.partitionBy("customer_id").orderBy("day", "seq")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    plain = (df.withColumn("prev_v", F.lag("v").over(w)).withColumn("next_v", F.lead("v").over(w)).withColumn("last_v", F.last("v", ignorenulls=True).over(before))
               .withColumn("total", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
               .withColumn("s", F.sum("v").over(w.rowsBetween(-299, 0))).withColumn("c", F.count(F.lit(1)).over(w.rowsBetween(-299, 0))))
    got = ordered.neighbours(df, "customer_id", ["day", "seq"], ["v"], carry=["v"])
    got = ordered.running_sum(got, "customer_id", ["day", "seq"], "v", "total", "long")
    got = ordered.trailing(got, "customer_id", ["day", "seq"], 300, {"s": lambda f: F.sum("v").over(f), "c": lambda f: F.count(F.lit(1)).over(f)})
    cols = ["customer_id", "seq", "prev_v", "next_v", "last_v", "total", "s", "c"]
    assert tuples(got, *cols) == tuples(plain, *cols)


def test_halo_longer_than_ranges(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), "id")
    got = ordered.trailing(df, "k", "id", 90, {"n": lambda f: F.count(F.lit(1)).over(f), "low": lambda f: F.min("id").over(f)}, parts=16)
    assert tuples(got, "id", "n", "low") == sorted(((i, min(i + 1, 90), max(0, i - 89)) for i in range(200)), key=str)


@pytest.mark.parametrize("hot_days", [1, 300])
def test_compound_equals_day_by_day(spark, hot_days):
    df, rows = made(spark, hot_days, 1200)
    got = {r.seq: r.balance for r in ordered.compound(df, "customer_id", "day", "v", annual_rate=36.5, tiebreak="seq").collect()}
    for k in {r[0] for r in rows}:
        balance, last = 0.0, None
        for _, day, seq, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3]):
            for _ in range((day - last).days if last else 0):
                balance *= 1.1
            balance, last = balance + (v or 0), day
            assert abs(got[seq] - balance) <= 1e-9 * max(1.0, abs(balance), 1.1 ** 60)


@pytest.mark.parametrize("inclusive", [True, False])
def test_in_force_with_many_changes(spark, inclusive):
    facts, rows = made(spark, 40)
    rng = random.Random(9)
    changes = [(rng.choice([7, 7, 7, None, 1, 2]), rng.choice([None, DAY + dt.timedelta(rng.randrange(-5, 60))]), i, f"plan{i}") for i in range(900)]
    facts = facts.unionByName(spark.createDataFrame([(7, None, 10**6, 1)], facts.schema))
    table = spark.createDataFrame(changes, "customer_id long, since date, n int, plan string")
    got = {r.seq: r.plan for r in ordered.in_force(facts, table, "customer_id", "day", "since", ["plan"], tiebreak="n", inclusive=inclusive).collect()}
    assert len(got) == len(rows) + 1
    for k, day, seq, _ in [*rows, (7, None, 10**6, 1)]:
        mine = sorted((s, n, p) for c, s, n, p in changes if c == k and s)
        at = 0 if day is None else (bisect_right if inclusive else bisect_left)([m[0] for m in mine], day)
        assert got[seq] == (mine[at - 1][2] if at else None)


def test_empty(spark):
    df, _ = made(spark)
    none = df.limit(0)
    assert ordered.neighbours(none, "customer_id", "seq", "v", carry="v").collect() == []
    assert ordered.running_sum(none, "customer_id", "seq", "v", "t").collect() == []
    assert ordered.compound(none, "customer_id", "day", "v").collect() == []
    assert ranges.number_rows(none, ["seq"]).collect() == []


def test_number_rows(spark):
    df, rows = made(spark)
    out = ranges.number_rows(df.repartition(7), ["day", "seq"])
    assert tuples(out, "row_number", "seq") == sorted(((i + 1, r[2]) for i, r in enumerate(sorted(rows, key=lambda r: r[1:3]))), key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_one_customer_in_one_month_is_spread(spark):
    """Half of 200,000 rows are one customer's, on a single day: largest range at most three
    times the median one, and the window's tasks as well."""
    t = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("customer_id"), F.lit(DAY).alias("day"), "id")
    heavy = ranges.heavy_keys(t, "customer_id")
    assert [r.customer_id for r in heavy.collect()] == [7]
    parts = ranges.cut(t.where("customer_id = 7"), ["customer_id", "day", "id"], parts=64)
    sizes = sorted(r["count"] for r in parts.groupBy("_part").count().collect())
    assert len(sizes) >= 32 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    out = ordered.running_sum(t, "customer_id", ["day", "id"], "id", "total", "long", parts=64)
    per_task = sorted(r["count"] for r in out.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect())
    assert per_task[-1] <= 3 * per_task[len(per_task) // 2]
