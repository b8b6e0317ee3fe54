"""Ingredient bill and usage on the source's 14 order lines (edge cases: repeats,
two-digit ids, an extra equal to a base item, an exclusion not in the base)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebook.operators import cleaning as CL
from casebook.operators import recipes as RE
from casebook.sources.adapters import TOPPINGS
from conftest import rows


@pytest.fixture(scope="module")
def pizza(spark):
    T = dt.datetime(2020, 1, 1)
    raw = spark.createDataFrame([
        (1, 101, 1, "", ""), (2, 101, 1, "", ""), (3, 102, 1, "", ""), (3, 102, 2, "", None),
        (4, 103, 1, "4", ""), (4, 103, 1, "4", ""), (4, 103, 2, "4", ""), (5, 104, 1, "null", "1"),
        (6, 101, 2, "null", "null"), (7, 105, 2, "null", "1"), (8, 102, 1, "null", "null"),
        (9, 103, 1, "4", "1, 5"), (10, 104, 1, "null", "null"), (10, 104, 1, "2, 6", "1, 4"),
    ], "order_id int, customer_id int, pizza_id int, exclusions string, extras string")
    raw = raw.withColumn("order_time", F.lit(T).cast("timestamp_ntz"))
    lines = CL.clean_customer_orders(raw)
    recipes = spark.createDataFrame([(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")], "pizza_id int, toppings string")
    names = spark.createDataFrame([(1, "Meatlovers"), (2, "Vegetarian")], "pizza_id int, pizza_name string")
    tops = spark.createDataFrame(TOPPINGS, "topping_id int, topping_name string")
    return lines, recipes, names, tops


def test_bill(pizza):
    lines, recipes, names, _ = pizza
    bill = {(r.order_id, r.line_id): r.ingredient_list
            for r in RE.ingredient_bill(lines, recipes, names, TOPPINGS).collect()}
    # names sort in binary (code point) order: "BBQ Sauce" < "Bacon", "Tomato Sauce" < "Tomatoes"
    assert bill[(1, 1)] == "Meatlovers: BBQ Sauce, Bacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"
    assert bill[(5, 1)] == "Meatlovers: BBQ Sauce, 2xBacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"
    assert bill[(9, 1)] == "Meatlovers: BBQ Sauce, 2xBacon, Beef, 2xChicken, Mushrooms, Pepperoni, Salami"
    assert bill[(4, 1)] == "Meatlovers: BBQ Sauce, Bacon, Beef, Chicken, Mushrooms, Pepperoni, Salami"
    assert bill[(4, 3)] == "Vegetarian: Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes"
    assert bill[(10, 1)] == "Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami"


def test_usage_equals_set_ops(pizza, spark):
    lines, recipes, _, tops = pizza
    arr = rows(RE.ingredient_usage(lines, recipes, tops), "topping_id", "n_used")
    k = ["order_id", "line_id"]
    base = lines.join(CL.bridge_table(recipes), "pizza_id").select(*k, "topping_id")
    ex = CL.explode_list(lines, "exclusions", keep=k, out="topping_id", parsed=True)
    xt = CL.explode_list(lines, "extras", keep=k, out="topping_id", parsed=True)
    setops = base.subtract(ex).unionAll(xt).groupBy("topping_id").count()
    assert arr == rows(setops, "topping_id", "count")
    # property: total = base - effective exclusions + extras
    total = sum(n for _, n in arr)
    assert total == base.count() - base.join(ex, k + ["topping_id"], "left_semi").count() + xt.count()


def test_labels(pizza):
    lines, _, names, _ = pizza
    m = CL.dictionary_map(TOPPINGS)
    j = lines.join(names, "pizza_id")
    lab = j.select("order_id", "line_id", CL.line_label("pizza_name", [("Exclude", CL.decode_array("exclusions", m)),
                                                                    ("Extra", CL.decode_array("extras", m))]).alias("l"))
    got = {(r.order_id, r.line_id): r.l for r in lab.collect()}
    assert got[(1, 1)] == "Meatlovers"
    assert got[(9, 1)] == "Meatlovers - Exclude Cheese - Extra Bacon, Chicken"
    assert "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese" in {got[(10, 1)], got[(10, 2)]}


def test_revenue_fixture(pizza, spark):
    lines = pizza[0]
    price = F.when(F.col("pizza_id") == 1, 12).otherwise(10)
    r = RE.revenue(lines, price).collect()[0][0]
    assert r == 160
    r1 = RE.revenue(lines, price, surcharge_per_extra=1).collect()[0][0]
    assert r1 == 166


@pytest.fixture(scope="module")
def deliveries(spark):
    raw = spark.createDataFrame([
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
        (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
        (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
        (5, 3, "2020-01-08 21:10:57", "10", "15", None),
        (6, 3, "null", "null", "null", "Restaurant Cancellation"),
        (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
        (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
        (9, 2, "null", "null", "null", "Customer Cancellation"),
        (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
    ], "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    return CL.clean_runner_orders(raw)


def test_revenue_anchors(pizza, deliveries):
    """Source anchors: 160 all / 138 delivered; with a 1 surcharge per extra 166 / 142;
    delivered revenue net of 0.30 per km (distance once per order) 94.44."""
    from casebook.operators import aggregates as AG
    lines = pizza[0]
    price = F.when(F.col("pizza_id") == 1, 12).otherwise(10)
    flag = deliveries.select("order_id", F.col("cancellation").isNull().alias("delivered"))
    got = {r.delivered: (r.revenue, r.revenue_with_extras)
           for r in AG.revenue_by(lines.join(flag, "order_id"), "delivered", price, "extras", 1).collect()}
    assert got[True] == (138, 142)
    assert got[True][0] + got[False][0] == 160 and got[True][1] + got[False][1] == 166
    net = RE.net_of_distance_cost(lines, deliveries, price, cost_per_km=0.30).collect()[0]
    assert float(net.net_revenue) == pytest.approx(94.44)


def test_delivery_report_fixture(pizza, deliveries, spark):
    lines = pizza[0]
    ratings = spark.createDataFrame([(1, 3), (2, 4), (3, 5)], "order_id int, rating int")
    rep = {r.order_id: r for r in RE.delivery_report(lines, deliveries, ratings).collect()}
    assert sorted(rep) == [1, 2, 3, 4, 5, 7, 8, 10]
    assert rep[3].n_items == 2 and rep[3].rating == 5 and rep[4].rating is None
    assert rep[8].avg_speed_kmh == pytest.approx(93.6)   # 23.4 km in 15 min


def test_exclusion_not_in_base_and_repeated_extra(spark, pizza):
    _, recipes, _, _ = pizza
    lines = spark.createDataFrame([(1, 1, 2, [1, 1], [4, 4])],
                                  "order_id int, line_id int, pizza_id int, exclusions array<int>, extras array<int>")
    got = RE.line_ingredients(lines, recipes).collect()[0].ingredients
    # exclusion 1 (not on pizza 2) is a no-op; extra 4 is also a base item -> three times
    assert sorted(got) == [4, 4, 4, 6, 7, 9, 11, 12]
