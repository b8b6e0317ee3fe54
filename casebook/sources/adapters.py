"""Domain tables derived from the driver's star schema.

The analyses are written against small business tables (sales, subscriptions, bank
transactions, delivery orders). These adapters derive tables of the same shape from
``orders``/``lineitem``/``part``/``customer``/``nation``/``region``/``events`` so
every query's work grows with the input. Each adapter is a lazy projection (plus at
most one aggregate or window); nothing is collected.

The same derivations are written as SQL in :mod:`casebook.oracle` for the DuckDB
cross-check, so any change here must be mirrored there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.plans.broadcast import broadcast_if_small, literal_table
from casebook.sources.tables import read_table

OPEN_END = "9999-12-31"


def _date(c):
    return F.col(c).cast("date")


# ---------------------------------------------------------------- restaurant (sales)

def sales(spark: SparkSession, d: str) -> DataFrame:
    """customer_id BIGINT, order_date DATE, product_id BIGINT (one row per line)."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("customer_id"),
                      _date("o_orderdate").alias("order_date"),
                      F.col("l_partkey").alias("product_id")))


def menu(spark: SparkSession, d: str) -> DataFrame:
    """product_id BIGINT, product_name STRING, price DECIMAL(12,2)."""
    return read_table(spark, d, "part", "p_partkey", "p_name", "p_retailprice").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"))


def members(spark: SparkSession, d: str, segment: str = "BUILDING",
            days_after_first_order: int = 365) -> DataFrame:
    """customer_id BIGINT, join_date DATE: customers of one market segment, joining
    the programme a fixed number of days after their first order."""
    c = read_table(spark, d, "customer", "c_custkey", "c_mktsegment").filter(F.col("c_mktsegment") == segment)
    first = (read_table(spark, d, "orders", "o_custkey", "o_orderdate")
             .groupBy("o_custkey").agg(F.min(_date("o_orderdate")).alias("first_order")))
    return (c.join(first, c.c_custkey == first.o_custkey)
             .select(F.col("c_custkey").alias("customer_id"),
                     F.date_add("first_order", days_after_first_order).alias("join_date")))


# ---------------------------------------------------------------- subscriptions

# The plan dimension (id, name, price; churn has no price).
PLANS = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]


def plans(spark: SparkSession) -> DataFrame:
    """plan_id INT, plan_name STRING, price DECIMAL(5,2) (5 literal rows, broadcast)."""
    return literal_table(spark, PLANS, ["plan_id", "plan_name", "price"], ["int", "string", "decimal(5,2)"])


def subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """customer_id BIGINT, plan_id INT, start_date DATE, sub_seq BIGINT.

    One state change per order: the plan is the order priority's leading digit - 1
    (five values, five plans); ``sub_seq`` (the order key) breaks ties between two
    changes of one customer on one day.
    """
    return read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").select(
        F.col("o_custkey").alias("customer_id"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
        _date("o_orderdate").alias("start_date"),
        F.col("o_orderkey").alias("sub_seq"))


# ---------------------------------------------------------------- bank

def regions(spark: SparkSession, d: str) -> DataFrame:
    """region_id INT, region_name STRING (broadcast after a size check: facts are
    joined to it on a handful of keys)."""
    return broadcast_if_small(read_table(spark, d, "region", "r_regionkey", "r_name").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")))


def customer_nodes(spark: SparkSession, d: str, ends: bool = True) -> DataFrame:
    """customer_id BIGINT, region_id INT, node_id INT, start_date DATE, end_date DATE.

    Each order starts a node allocation that lasts until the customer's next order;
    the last one is open (``9999-12-31``). Without ``ends`` no end is looked for. A very
    active customer is split into equal ranges (:mod:`casebook.operators.ordered`).
    """
    from casebook.operators.ordered import neighbours
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, d, "customer", "c_custkey", "c_nationkey")
    n = broadcast_if_small(read_table(spark, d, "nation", "n_nationkey", "n_regionkey"))
    base = o.select("o_custkey", "o_orderkey", _date("o_orderdate").alias("start_date"))
    end = []
    if ends:
        base = neighbours(base, "o_custkey", ["start_date", "o_orderkey"], "start_date", prev=False)
        end = [F.coalesce(F.col("next_start_date"), F.lit(OPEN_END).cast("date")).alias("end_date")]
    return (base.join(c, base.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
               .select(F.col("o_custkey").alias("customer_id"),
                       F.col("n_regionkey").alias("region_id"),
                       (F.col("o_orderkey") % 5 + 1).cast("int").alias("node_id"),
                       "start_date", *end))


def _txn_type_from_status():
    return (F.when(F.col("o_orderstatus") == "F", "deposit")
             .when(F.col("o_orderstatus") == "O", "purchase")
             .when(F.col("o_orderstatus") == "P", "withdrawal"))


def customer_transactions(spark: SparkSession, d: str) -> DataFrame:
    """customer_id BIGINT, txn_date DATE, txn_type STRING, txn_amount DECIMAL(12,2)
    (one per order; status F/O/P = deposit/purchase/withdrawal)."""
    return read_table(spark, d, "orders", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice").select(
        F.col("o_custkey").alias("customer_id"), _date("o_orderdate").alias("txn_date"),
        _txn_type_from_status().alias("txn_type"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("txn_amount"))


def event_transactions(spark: SparkSession, d: str) -> DataFrame:
    """Daily-grain ledger from the event stream: customer_id BIGINT, txn_date DATE,
    txn_type STRING, txn_amount DECIMAL(12,2). purchase/signup -> deposit,
    click -> purchase, error -> withdrawal, anything else keeps its name (neutral)."""
    e = read_table(spark, d, "events", "user_id", "ts", "event_type", "value")
    t = F.col("event_type")
    return e.select(
        F.col("user_id").alias("customer_id"), _date("ts").alias("txn_date"),
        F.when(t.isin("purchase", "signup"), "deposit").when(t == "click", "purchase")
         .when(t == "error", "withdrawal").otherwise(t).alias("txn_type"),
        F.col("value").cast("decimal(12,2)").alias("txn_amount"))


# ---------------------------------------------------------------- delivery (pizza)

# The topping dictionary (id, name).
TOPPINGS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
    (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"),
    (11, "Tomatoes"), (12, "Tomato Sauce"),
]
N_TOPPINGS = len(TOPPINGS)
N_PIZZAS = 25  # pizza ids are brand numbers 1..25


def pizza_toppings(spark: SparkSession) -> DataFrame:
    """topping_id INT, topping_name STRING (12 literal rows, broadcast)."""
    return literal_table(spark, TOPPINGS, ["topping_id", "topping_name"], ["int", "string"])


def pizza_names(spark: SparkSession, d: str) -> DataFrame:
    """pizza_id INT, pizza_name STRING: one pizza per part brand. Joined against
    order lines on a tiny key domain, so it is broadcast after a size check
    (:func:`casebook.plans.broadcast.broadcast_if_small`)."""
    names = (read_table(spark, d, "part", "p_brand")
             .select(F.substring("p_brand", 7, 10).cast("int").alias("pizza_id"),
                     F.col("p_brand").alias("pizza_name"))
             .distinct())
    return broadcast_if_small(names)


def pizza_recipes(spark: SparkSession, d: str, names: DataFrame | None = None) -> DataFrame:
    """pizza_id INT, toppings STRING (raw delimited list, 4 or 5 topping ids).
    ``names``: the pizza names already built by the caller (avoids a second pass)."""
    b = F.col("pizza_id")
    ids = [(b + k) % N_TOPPINGS + 1 for k in (0, 3, 5, 8)]
    base = F.concat_ws(", ", *[i.cast("string") for i in ids])
    fifth = ((b + 10) % N_TOPPINGS + 1).cast("string")
    return (names if names is not None else pizza_names(spark, d)).select(
        "pizza_id",
        F.when(b % 3 == 0, F.concat(base, F.lit(","), fifth)).otherwise(base).alias("toppings"))


def _order_offset_seconds():
    k = F.col("o_orderkey")
    return (k % 600) * 60 + k % 59


def customer_orders_raw(spark: SparkSession, d: str, line_id: str | None = None) -> DataFrame:
    """order_id BIGINT, customer_id BIGINT, pizza_id INT, exclusions STRING,
    extras STRING, order_time TIMESTAMP_NTZ -- one row per line item, with the
    list columns in the dirty forms seen in the source ('null', '', NULL, '1, 5',
    '11,2', repeats).

    ``line_id``: adds each line's number within its order, by pizza, exclusions and extras
    as they are spelled. The lines are numbered before the orders join, which needs no
    other exchange of them; a huge order is numbered by ranges."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    p, s, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    s_id = (s % N_TOPPINGS + 1).cast("string")
    p_id = (p % N_TOPPINGS + 1).cast("string")
    ps_id = ((p + s) % N_TOPPINGS + 1).cast("string")
    exclusions = (F.when(ln % 5 == 0, F.lit(None).cast("string"))
                   .when(ln % 5 == 1, "null").when(ln % 5 == 2, "")
                   .when(ln % 5 == 3, s_id)
                   .otherwise(F.concat(s_id, F.lit(", "), p_id)))
    extras = (F.when(ln % 4 == 0, p_id)
               .when(ln % 4 == 1, F.concat(p_id, F.lit(","), ps_id))
               .when(ln % 4 == 2, "null")
               .otherwise(F.lit(None).cast("string")))
    lines = li.select("l_orderkey", (p % N_PIZZAS + 1).cast("int").alias("pizza_id"), exclusions.alias("exclusions"), extras.alias("extras"))
    if line_id:
        from casebook.operators.ordered import numbered
        lines = numbered(lines, "l_orderkey", ["pizza_id", "exclusions", "extras"], line_id)
    return (lines.join(o, lines.l_orderkey == o.o_orderkey)
              .select(F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                      "pizza_id", "exclusions", "extras",
                      F.timestamp_add("SECOND", _order_offset_seconds(), F.col("o_orderdate")).alias("order_time"),
                      *([line_id] if line_id else [])))


def order_summaries(spark: SparkSession, d: str) -> DataFrame:
    """order_id BIGINT, customer_id BIGINT, order_time TIMESTAMP_NTZ, n_items BIGINT: the
    order lines' view of each order. Lines are counted before they meet the orders, so an
    order of very many lines is one row a task."""
    items = read_table(spark, d, "lineitem", "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_items"))
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return (o.join(items, o.o_orderkey == items.l_orderkey)
             .select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                     F.timestamp_add("SECOND", _order_offset_seconds(), F.col("o_orderdate")).alias("order_time"), "n_items"))


def runner_orders_raw(spark: SparkSession, d: str) -> DataFrame:
    """order_id BIGINT, runner_id INT, pickup_time/distance/duration/cancellation as
    dirty STRINGs ('20km', '23.4 km', '32 minutes', '25mins', 'null', '')."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    cancelled = (F.col("o_orderstatus") == "P") & (k % 3 == 0)
    pickup_secs = _order_offset_seconds() + 300 + (k % 37) * 60 + (k % 13) * 4
    # 'yyyy-MM-dd HH:mm:ss' text of the wall-clock time (casting a TIMESTAMP_NTZ to
    # string does not pass through the session time zone, date_format would)
    pickup = F.timestamp_add("SECOND", pickup_secs, F.col("o_orderdate")).cast("string")
    km = F.concat(F.floor(F.col("o_totalprice") / 20000).cast("bigint").cast("string"), F.lit("."),
                  (k % 10).cast("string"))
    km_sfx = (F.when(k % 4 == 0, "km").when(k % 4 == 1, " km").when(k % 4 == 2, "").otherwise("km "))
    mins = (k % 31 + 10).cast("string")
    min_sfx = (F.when(k % 5 == 0, " minutes").when(k % 5 == 1, "mins").when(k % 5 == 2, " minute")
                .when(k % 5 == 3, "").otherwise("minutes"))
    cancellation = (F.when(cancelled & (k % 2 == 0), "Restaurant Cancellation")
                     .when(cancelled, "Customer Cancellation")
                     .when(k % 7 == 0, "null").when(k % 7 == 1, "")
                     .otherwise(F.lit(None).cast("string")))
    return o.select(
        k.alias("order_id"), (k % 10 + 1).cast("int").alias("runner_id"),
        F.when(cancelled, "null").otherwise(pickup).alias("pickup_time"),
        F.when(cancelled, "null").otherwise(F.concat(km, km_sfx)).alias("distance"),
        F.when(cancelled, "null").otherwise(F.concat(mins, min_sfx)).alias("duration"),
        cancellation.alias("cancellation"))


def runners(spark: SparkSession, d: str) -> DataFrame:
    """runner_id BIGINT, registration_date DATE (one runner per customer row)."""
    return read_table(spark, d, "customer", "c_custkey").select(
        F.col("c_custkey").alias("runner_id"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("registration_date"))
