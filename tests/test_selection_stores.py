"""Percentiles by selection, sketches, kept tables, quarantine, bit sets."""

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from casebook.catalog import QUERIES
from casebook.functions.bits import bit_set, count_vector, without
from casebook.operators import ordered, ranges
from casebook.operators import recipes as RE
from casebook.operators import sketches as SK
from casebook.operators.selection import quantiles
from casebook.plans.inspect import exchanges, physical_plan
from casebook.sources import adapters as A
from casebook.sources import stores
from casebook.sources.io import save_table
from casebook.sources.quarantine import account, split_typed

POINTS = {"lo": 0.0, "p50": 0.5, "p80": 0.8, "p95": 0.95, "hi": 1.0}


def test_quantiles_equal_percentile(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "a", "a", "b", "c"]), rng.choice([None, rng.randrange(10**9), rng.randrange(5)])) for _ in range(4000)] + [("one", 7), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    want = df.groupBy("g").agg(F.count("v").alias("n"), *[F.percentile("v", F.lit(p)).alias(n) for n, p in POINTS.items()]).where("n > 0").drop("n")
    assert sorted(map(tuple, quantiles(df, "g", "v", POINTS, parts=16).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    whole = df.agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in POINTS.items()])
    assert list(map(tuple, quantiles(df, None, "v", POINTS, parts=16).collect())) == list(map(tuple, whole.collect()))
    assert quantiles(df.limit(0), "g", "v", POINTS).collect() == []


def test_quantiles_keep_no_group_in_one_task(spark):
    """No percentile buffer in the plan, and one group's values lie in many ranges."""
    df = spark.range(50_000).select(F.lit("a").alias("g"), F.xxhash64("id").alias("v"))
    out = quantiles(df, "g", "v", POINTS, parts=32)
    plan = physical_plan(out, "simple")
    assert "percentile" not in plan.lower().replace("percentiles", "") and "SinglePartition" not in plan
    sizes = [r["count"] for r in ranges.cut(df, ["g", "v"], parts=32).groupBy("_part").count().collect()]
    assert len(sizes) == 32 and max(sizes) <= 3 * sorted(sizes)[16]


def test_numbered_equals_row_number(spark):
    rng = random.Random(4)
    rows = [(7 if i % 2 else rng.randrange(50), rng.choice([None, rng.randrange(40)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, a int, seq int")
    got = {r.seq: r.n for r in ordered.numbered(df, "k", ["a", "seq"], "n").collect()}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in mine] == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("kind", ["hll", "theta"])
def test_sketches_roll_up_and_meet(spark, kind):
    """Merged daily sketches are as good as one of all rows; errors stay within bounds."""
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.pmod(F.xxhash64("id"), F.lit(25_000)).alias("who"))
    exact = df.select("who").distinct().count()
    days = SK.distinct_sketches(df, "day", "who", kind=kind)
    about = SK.roll_up(days, None, kind=kind).select(SK.estimate("sketch", kind)).first()[0]
    assert abs(about - exact) <= 4 * 1.04 / 64 * exact
    if kind == "theta":
        a, b = (SK.distinct_sketches(spark.range(lo, lo + 20_000), None, "id", n, kind=kind) for lo, n in ((0, "a"), (12_000, "b")))
        both = a.crossJoin(b).select(SK.in_both("a", "b")).first()[0]
        assert abs(both - 8_000) <= 4 / 64 * 32_000


def test_sketch_bound_grows_with_the_count(spark):
    row = spark.range(1).select(SK.bound(F.lit(10_000)).alias("hll"), SK.bound(F.lit(10_000), kind="theta").alias("theta")).first()
    assert (row.hll, row.theta) == (650, 625)


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = lambda month, v: spark.range(100).select(F.col("id").alias("k"), F.lit(v).alias("v"), F.lit(month).alias("month"))
    stores.replace_partitions(rows("2024-01", 1).union(rows("2024-02", 1)), path, ["month"], ["k"], files=2)
    stores.replace_partitions(rows("2024-02", 2), path, ["month"], ["k"], files=2)
    read = spark.read.parquet(path)
    assert sorted((r.month, r.v, r["count"]) for r in read.groupBy("month", "v").count().collect()) == [("2024-01", 1, 100), ("2024-02", 2, 100)]
    files = read.where("month = '2024-02'").select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), "k").collect()
    for f in {r.f for r in files}:  # sorted within each file
        keys = [r.k for r in sorted((r for r in files if r.f == f), key=lambda r: r.at)]
        assert keys == sorted(keys)


def test_save_table_sorts_within_files(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(spark.range(1000).select((F.lit(1000) - F.col("id")).alias("k")).repartition(3), path, sort_within=["k"])
    rows = spark.read.parquet(path).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), "k").collect()
    assert len({r.f for r in rows}) == 3
    for f in {r.f for r in rows}:
        keys = [r.k for r in sorted((r for r in rows if r.f == f), key=lambda r: r.at)]
        assert keys == sorted(keys)


def test_shared_table_is_built_once_for_a_version(spark, tmp_path):
    source, built = str(tmp_path / "s"), []
    spark.range(3).write.parquet(source)

    def build(place):
        built.append(place)
        spark.read.parquet(source).write.parquet(place)
        return spark.read.parquet(place)

    assert [stores.shared(spark, "t", [source], build).count() for _ in range(3)] == [3, 3, 3] and len(built) == 1
    spark.range(5).write.mode("overwrite").parquet(source)
    assert stores.shared(spark, "t", [source], build).count() == 5 and len(set(built)) == 2


def test_allocation_queries_share_one_ledger(spark):
    before = len(stores._BUILT)
    for name in ("daily_balances", "allocation_month_end", "allocation_trailing_30", "allocation_realtime", "interest_accrual"):
        files = QUERIES[name](spark, SF_SMALL).inputFiles()
        assert files and all("casebook-shared/daily-ledger" in f or "casebook-stage/trailing" in f for f in files), name
    assert len(stores._BUILT) <= before + 1
    plan = physical_plan(QUERIES["closing_balances_in_month"](spark, SF_SMALL), "simple")
    assert "PartitionFilters: [isnotnull(month" in plan and "2024-01" in plan


def test_bucketed_join_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["quantity_per_customer_bucketed"](spark, SF_SMALL)
        plan = physical_plan(df, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below and exchanges(df)["hash"] == 1  # the one of the group by


def test_business_tables_are_read_without_a_job(spark):
    from casebook.sources.tables import SCHEMAS, read_table
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for name in SCHEMAS:
        read_table(spark, SF_SMALL, name)
    A.sales(spark, SF_SMALL)
    assert set(tracker.getJobIdsForGroup(None)) == before
    for name in SCHEMAS:
        assert read_table(spark, SF_SMALL, name).schema.simpleString() == spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema.simpleString()


def test_quarantine_accounts_for_every_cell(spark):
    rows = [(1, "12", "2024-01-01"), (2, "x", None), (3, "null", "2024-13-01"), (4, "", "soon"), (None, None, " "), (5, " 7 ", "2024-02-29")]
    df = spark.createDataFrame(rows, "id long, n string, day string")
    types = {"n": "int", "day": "date"}
    typed, bad = split_typed(df, types, "id")
    assert [(r.id, r.n, str(r.day)) for r in typed.collect()] == [(1, 12, "2024-01-01"), (2, None, "None"), (3, None, "None"), (4, None, "None"), (None, None, "None"), (5, 7, "2024-02-29")]
    assert sorted(map(tuple, bad.collect())) == [(2, "n", "int", "x"), (3, "day", "date", "2024-13-01"), (4, "day", "date", "soon")]
    assert sorted(map(tuple, account(df, types).collect())) == [("day", 2, 2, 2), ("n", 3, 2, 1)]


def test_bit_sets(spark):
    df = spark.createDataFrame([([1, 5, 5, 62], [5], [5, 7, 7]), ([], None, None), (None, [1], [1]), ([0, 63, -1, None], [0], [])], "a array<int>, b array<int>, c array<int>")
    kept = without(bit_set("a"), bit_set("b"))
    out = df.select(kept.alias("kept"), F.struct(*[c.alias(f"m{m}") for m, c in count_vector(kept, "c", [1, 5, 7, 62]).items()]).alias("n")).collect()
    assert [r.kept for r in out] == [(1 << 1) | (1 << 62), 0, 0, 0]
    assert [tuple(r.n) for r in out] == [(1, 1, 2, 1), (0, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 0)]


def test_three_ways_of_ingredient_usage_agree(spark):
    """Repeated, unlisted and null entries, and lines alike."""
    lines = spark.createDataFrame([(1, [2], [2, 2, 9]), (1, [2], [2, 2, 9]), (1, None, None), (2, [4, 4], []), (2, [], [1]), (2, [7], None)], "pizza_id int, exclusions array<int>, extras array<int>")
    recipes = spark.createDataFrame([(1, "1, 2,3"), (2, "4, 4, 5")], "pizza_id int, toppings string")
    names = A.pizza_toppings(spark)
    got = [sorted(map(tuple, df.select("topping_id", "n_used").collect())) for df in
           (RE.ingredient_usage(lines, recipes, names), RE.usage_by_set_ops(lines, recipes, names), RE.usage_by_bits(lines, recipes, A.TOPPINGS))]
    assert got[0] == got[1] == got[2] == [(1, 4), (2, 5), (3, 3), (4, 2), (5, 3), (9, 2)]


def test_set_ops_and_bits_do_not_shuffle_lines_again(spark):
    """One exchange less for lines alike; the bit form has none of the list work's."""
    bits = physical_plan(QUERIES["ingredient_usage_bits"](spark, SF_SMALL), "simple")
    assert "line_id" not in physical_plan(QUERIES["ingredient_usage_set_ops"](spark, SF_SMALL), "simple")
    assert "Window" not in bits and exchanges(QUERIES["ingredient_usage_bits"](spark, SF_SMALL))["hash"] <= 3


def test_line_ids_scan_orders_once(spark):
    for name in ("clean_customer_orders", "ingredient_bill"):
        plan = physical_plan(QUERIES[name](spark, SF_SMALL), "simple")
        assert plan.count("ReadSchema: struct<o_orderkey") == 1 and plan.count("ReadSchema: struct<l_orderkey") == 1, name
