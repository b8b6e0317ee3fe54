"""Physical-plan properties of the catalogue: no Python evaluation, no
single-partition exchange, and the shuffle budget of the flagship operators."""

import re

import pytest
from pyspark.sql import functions as F

from casebook.catalog import QUERIES
from casebook.plans.inspect import exchanges
from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_single_partition(spark, name):
    """No Python evaluation, and every single-partition exchange feeds the final step
    of a global aggregate (``keys=[]``, after a partial aggregate) or of a top-k:
    never a window or a sort of a whole table."""
    from casebook.plans.inspect import physical_plan
    df = QUERIES[name](spark, SF_SMALL)
    assert exchanges(df)["python"] == 0
    lines = physical_plan(df, "simple").splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            parent = lines[i - 1]
            global_agg = r"(Hash|ObjectHash|Sort)Aggregate\(keys?=\[\]"
            assert (re.search(global_agg, parent) or "TakeOrderedAndProject" in parent
                    or "GlobalLimit" in parent), (name, parent)
            below = lines[i + 1]
            assert (re.search(global_agg, below) or "LocalLimit" in below or "TakeOrdered" in below), (name, below)


def test_ledger_one_shuffle(spark):
    """Unsplit ledger: a single hash exchange on the customer (the payment rows are
    generated narrowly and never sorted) plus the broadcast literal plan table."""
    from casebook.operators import billing as BI
    from casebook.sources import adapters as A
    ex = exchanges(BI.billing_ledger(A.subscriptions(spark, SF_SMALL), A.plans(spark), "2001-12-31"))
    assert ex["hash"] == 1 and ex["single"] == 0 and ex["broadcast"] == 1


def test_scans_are_pruned(spark):
    from casebook.plans.inspect import physical_plan
    text = physical_plan(QUERIES["spend_per_customer"](spark, SF_SMALL), "simple")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    text = physical_plan(QUERIES["plan_starts_after_year"](spark, SF_SMALL), "simple")
    assert "l_extendedprice" not in text and "o_totalprice" not in text


@pytest.mark.parametrize("name", ["favourite_item_per_customer", "favourite_items_all_ties", "first_day_items_all_ties"])
def test_per_key_top_k_is_limited_before_the_shuffle(spark, name):
    from casebook.plans.inspect import physical_plan
    text = physical_plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["first_item_after_joining", "last_item_before_joining", "spend_before_joining",
                                  "loyalty_points_first_week", "loyalty_points_eight_day_window"])
def test_hot_customer_is_reduced_to_days_before_the_member_join(spark, name):
    """The facts are hashed by customer and day, so one customer's rows go to many tasks."""
    from casebook.plans.inspect import physical_plan
    text = physical_plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert re.search(r"hashpartitioning\(customer_id#\d+L?, order_date#\d+", text)


def test_churn_share_does_not_multiply_rows(spark):
    from casebook.plans.inspect import physical_plan
    assert "Expand" not in physical_plan(QUERIES["churn_share"](spark, SF_SMALL), "simple")


def test_no_cross_join_anywhere(spark):
    from casebook.plans.inspect import physical_plan
    for name, fn in QUERIES.items():
        text = physical_plan(fn(spark, SF_SMALL), "simple")
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize("name,needle", [
    ("plan_mix_at_date", "LessThan(o_orderdate"),
    ("plan_starts_after_year", "GreaterThanOrEqual(o_orderdate"),
    ("annual_upgrades_in_year", "GreaterThanOrEqual(o_orderdate"),
    ("loyalty_points_first_week", "LessThan(o_orderdate"),
    ("first_item_after_joining", "EqualTo(c_mktsegment,BUILDING)"),
])
def test_date_and_segment_filters_reach_the_scan(spark, name, needle):
    from casebook.plans.inspect import physical_plan
    text = physical_plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert any("PushedFilters" in l and needle in l for l in text.splitlines())


def test_broadcast_if_small_checks_the_bound(spark):
    from casebook.plans.broadcast import broadcast_if_small
    from casebook.plans.inspect import physical_plan
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(50).withColumnRenamed("id", "k")
    facts = spark.range(1000).select((F.col("id") % 50).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = physical_plan(facts.join(broadcast_if_small(small, max_rows=20), "k"), "simple")
        plain = physical_plan(facts.join(broadcast_if_small(big, max_rows=20), "k"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in plain


def test_count_nodes(spark):
    from casebook.plans.inspect import count_nodes
    df = QUERIES["payment_ledger"](spark, SF_SMALL)
    assert count_nodes(df, r"Generate posexplode") == 1
    assert count_nodes(df, r"Window \[") >= 1
