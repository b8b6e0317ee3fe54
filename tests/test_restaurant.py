"""Restaurant operators on the source's own 15-row sales table (hand-derived anchors)."""

import datetime as dt
from decimal import Decimal

import pytest

from casebook.operators import aggregates as AG
from casebook.operators import loyalty as LO
from casebook.operators import sequence as SQ
from conftest import rows

D = dt.date


@pytest.fixture(scope="module")
def diner(spark):
    sales = spark.createDataFrame([
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
        ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3), ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2),
        ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1), ("B", D(2021, 1, 16), 3), ("B", D(2021, 2, 1), 3),
        ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3),
    ], "customer_id string, order_date date, product_id int")
    menu = spark.createDataFrame([(1, "sushi", Decimal("10")), (2, "curry", Decimal("15")), (3, "ramen", Decimal("12")),
                                  (9, "unsold", Decimal("99"))],
                                 "product_id int, product_name string, price decimal(12,2)")
    members = spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))], "customer_id string, join_date date")
    return sales, menu, members


def test_spend(diner):
    sales, menu, _ = diner
    out = AG.spend_by_key(sales, menu, "customer_id", "product_id", "price")
    assert rows(out, "customer_id", "total_spend") == [("A", 76), ("B", 74), ("C", 36)]
    pre = AG.spend_by_key(sales, menu, "customer_id", "product_id", "price", pre_aggregate=True)
    assert rows(pre) == rows(out)


def test_visits(diner):
    out = AG.visits(diner[0], "customer_id", "order_date")
    assert rows(out, "customer_id", "n_visit_days", "n_purchases") == [("A", 4, 6), ("B", 6, 6), ("C", 2, 3)]


def test_first_item_tiebreak_and_all_ties(diner):
    sales = diner[0]
    first = SQ.first_last_by(sales, "customer_id", "order_date", "product_id")
    assert rows(first, "customer_id", "product_id") == [("A", 1), ("B", 2), ("C", 3)]
    ties = SQ.first_last_by(sales, "customer_id", "order_date", "product_id", ties="all")
    assert rows(ties, "customer_id", "product_id") == [("A", 1), ("A", 2), ("B", 2), ("C", 3)]


def test_top_items(diner):
    sales = diner[0]
    top = AG.top_k_items(sales, "product_id", k=1, count_name="n")
    assert rows(top) == [(3, 8)]
    fav = AG.top_k_items(sales, "product_id", k=1, by="customer_id", count_name="n")
    # B bought 1, 2 and 3 twice each: tie broken by the smallest id
    assert rows(fav, "customer_id", "product_id", "n") == [("A", 3, 3), ("B", 1, 2), ("C", 3, 3)]
    fav_all = AG.top_k_items(sales, "product_id", k=1, by="customer_id", count_name="n", ties="all")
    assert [r for r in rows(fav_all, "customer_id", "product_id") if r[0] == "B"] == [("B", 1), ("B", 2), ("B", 3)]


def test_asof(diner):
    sales, menu, members = diner
    after = SQ.asof_event(sales, members, "customer_id", "order_date", "join_date", "product_id", "after")
    assert rows(after, "customer_id", "product_id") == [("A", 3), ("B", 1)]
    before = SQ.asof_event(sales, members, "customer_id", "order_date", "join_date", "product_id", "before")
    # A: two items on 2021-01-01 -> the larger id (deterministic); B: sushi on 01-04
    assert rows(before, "customer_id", "order_date", "product_id") == [("A", D(2021, 1, 1), 2), ("B", D(2021, 1, 4), 1)]
    facts = sales.join(menu, "product_id")
    tot = SQ.totals_before_anchor(facts, members, "customer_id", "order_date", "join_date", "price")
    assert rows(tot, "customer_id", "n_items", "amount_spent") == [("A", 2, 25), ("B", 3, 40)]


def test_points(diner):
    sales, menu, members = diner
    pts = LO.loyalty_points(sales, menu, "customer_id", "order_date", "product_id", "product_name", "price",
                            special_items=["sushi"])
    assert rows(pts, "customer_id", "points") == [("A", 860), ("B", 940), ("C", 360)]
    wk = LO.loyalty_points(sales, menu, "customer_id", "order_date", "product_id", "product_name", "price",
                           special_items=["sushi"], members=members, window_days=7, until="2021-01-31")
    # A: 20*10 + 15*10 (before) + 2x week: (15+12*3)*20 ; B: before 15*10*2 + 10*20, week 10*20, after 12*10
    assert rows(wk, "customer_id", "points") == [("A", 1370), ("B", 820)]


def test_fact_without_dimension_row(diner, spark):
    """A sale of an item missing from the menu counts as an item with no spend;
    a menu item nobody bought changes nothing."""
    sales, menu, _ = diner
    extra = spark.createDataFrame([("D", D(2021, 1, 3), 7)], sales.schema)
    out = {r.customer_id: (r.n_items, r.total_spend)
           for r in AG.spend_by_key(sales.unionByName(extra), menu, "customer_id", "product_id", "price").collect()}
    assert out["D"] == (1, None) and out["A"] == (6, 76)
