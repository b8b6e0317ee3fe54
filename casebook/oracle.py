"""DuckDB SQL oracle: a second, set-based formulation of every catalogue query.

It is a second opinion on the computation, not on the reading of a question: the domain
adapters' constants are imported and each question is read the way its operator reads it.

The driver's tables are views named ``region nation customer part orders lineitem
events ...``. The domain adapters of :mod:`casebook.sources.adapters` are repeated
here as CTEs (same derivation rules), then each question is answered in plain SQL
(joins, GROUP BY, window functions, EXCEPT/UNION, a recursive CTE for the ledger),
without reusing any Spark code path.
"""

from __future__ import annotations

from casebook.sources.adapters import N_PIZZAS, N_TOPPINGS, PLANS, TOPPINGS
from casebook import catalog as C

# ---------------------------------------------------------------- adapter CTEs

SALES = """sales AS (
  SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, l.l_partkey AS product_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

MENU = """menu AS (
  SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part)"""

MEMBERS = """members AS (
  SELECT c.c_custkey AS customer_id, f.first_order + 365 AS join_date
  FROM customer c
  JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order FROM orders GROUP BY o_custkey) f
    ON c.c_custkey = f.o_custkey
  WHERE c.c_mktsegment = 'BUILDING')"""


def _plans_values() -> str:
    rows = []
    for i, n, p in PLANS:
        price = "CAST(NULL AS DECIMAL(5,2))" if p is None else f"CAST({p} AS DECIMAL(5,2))"
        rows.append(f"({i}, '{n}', {price})")
    return ", ".join(rows)


PLANS_CTE = f"""plans AS (
  SELECT CAST(plan_id AS INTEGER) AS plan_id, plan_name, price FROM (VALUES {_plans_values()}) t(plan_id, plan_name, price))"""

SUBS = """subscriptions AS (
  SELECT o_custkey AS customer_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
         CAST(o_orderdate AS DATE) AS start_date, o_orderkey AS sub_seq
  FROM orders)"""

REGIONS = """regions AS (SELECT r_regionkey AS region_id, r_name AS region_name FROM region)"""

NODES = """customer_nodes AS (
  SELECT o.o_custkey AS customer_id, n.n_regionkey AS region_id, CAST(o.o_orderkey % 5 + 1 AS INTEGER) AS node_id,
         CAST(o.o_orderdate AS DATE) AS start_date,
         COALESCE(LEAD(CAST(o.o_orderdate AS DATE)) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey),
                  DATE '9999-12-31') AS end_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

TXNS = """customer_transactions AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
         CASE o_orderstatus WHEN 'F' THEN 'deposit' WHEN 'O' THEN 'purchase' WHEN 'P' THEN 'withdrawal' END AS txn_type,
         CAST(o_totalprice AS DECIMAL(12,2)) AS txn_amount
  FROM orders)"""

EVENT_TXNS = """event_txns AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS txn_date,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'deposit' WHEN event_type = 'click' THEN 'purchase'
              WHEN event_type = 'error' THEN 'withdrawal' ELSE event_type END AS txn_type,
         CAST(value AS DECIMAL(12,2)) AS txn_amount
  FROM events)"""

PIZZA_NAMES = """pizza_names AS (
  SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS pizza_id, p_brand AS pizza_name FROM part)"""

_T = N_TOPPINGS
PIZZA_RECIPES = f"""pizza_recipes AS (
  SELECT pizza_id,
         CASE WHEN pizza_id % 3 = 0 THEN base || ',' || CAST((pizza_id + 10) % {_T} + 1 AS VARCHAR) ELSE base END AS toppings
  FROM (SELECT pizza_id,
               CAST(pizza_id % {_T} + 1 AS VARCHAR) || ', ' || CAST((pizza_id + 3) % {_T} + 1 AS VARCHAR) || ', ' ||
               CAST((pizza_id + 5) % {_T} + 1 AS VARCHAR) || ', ' || CAST((pizza_id + 8) % {_T} + 1 AS VARCHAR) AS base
        FROM pizza_names) r)"""

TOPPINGS_CTE = "pizza_toppings AS (SELECT CAST(topping_id AS INTEGER) AS topping_id, topping_name FROM (VALUES " + \
    ", ".join(f"({i}, '{n}')" for i, n in TOPPINGS) + ") t(topping_id, topping_name))"


def _null_tok(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR lower(trim({x})) IN ('null', '') THEN NULL ELSE {x} END)"


def _int_list(x: str) -> str:
    return (f"(CASE WHEN {_null_tok(x)} IS NULL THEN NULL ELSE list_filter(list_transform(string_split({x}, ','), "
            f"lambda e: TRY_CAST(trim(e) AS INTEGER)), lambda e: e IS NOT NULL) END)")


def _measure(x: str, t: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({_null_tok(x)}, '^\\s*(-?[0-9]+(\\.[0-9]+)?)', 1), '') AS {t})"


_OFFSET = "((o.o_orderkey % 600) * 60 + o.o_orderkey % 59)"

ORDERS_RAW = f"""customer_orders_raw AS (
  SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, CAST(l.l_partkey % {N_PIZZAS} + 1 AS INTEGER) AS pizza_id,
         CASE WHEN l.l_linenumber % 5 = 0 THEN NULL WHEN l.l_linenumber % 5 = 1 THEN 'null'
              WHEN l.l_linenumber % 5 = 2 THEN '' WHEN l.l_linenumber % 5 = 3 THEN CAST(l.l_suppkey % {_T} + 1 AS VARCHAR)
              ELSE CAST(l.l_suppkey % {_T} + 1 AS VARCHAR) || ', ' || CAST(l.l_partkey % {_T} + 1 AS VARCHAR) END AS exclusions,
         CASE WHEN l.l_linenumber % 4 = 0 THEN CAST(l.l_partkey % {_T} + 1 AS VARCHAR)
              WHEN l.l_linenumber % 4 = 1 THEN CAST(l.l_partkey % {_T} + 1 AS VARCHAR) || ',' || CAST((l.l_partkey + l.l_suppkey) % {_T} + 1 AS VARCHAR)
              WHEN l.l_linenumber % 4 = 2 THEN 'null' ELSE NULL END AS extras,
         o.o_orderdate + to_seconds(CAST({_OFFSET} AS BIGINT)) AS order_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

RUNNER_RAW = f"""runner_orders_raw AS (
  SELECT o.o_orderkey AS order_id, CAST(o.o_orderkey % 10 + 1 AS INTEGER) AS runner_id,
         CASE WHEN cancelled THEN 'null'
              ELSE strftime(o.o_orderdate + to_seconds(CAST({_OFFSET} + 300 + (o.o_orderkey % 37) * 60 + (o.o_orderkey % 13) * 4 AS BIGINT)),
                            '%Y-%m-%d %H:%M:%S') END AS pickup_time,
         CASE WHEN cancelled THEN 'null'
              ELSE CAST(CAST(floor(o.o_totalprice / 20000) AS BIGINT) AS VARCHAR) || '.' || CAST(o.o_orderkey % 10 AS VARCHAR) ||
                   CASE o.o_orderkey % 4 WHEN 0 THEN 'km' WHEN 1 THEN ' km' WHEN 2 THEN '' ELSE 'km ' END END AS distance,
         CASE WHEN cancelled THEN 'null'
              ELSE CAST(o.o_orderkey % 31 + 10 AS VARCHAR) ||
                   CASE o.o_orderkey % 5 WHEN 0 THEN ' minutes' WHEN 1 THEN 'mins' WHEN 2 THEN ' minute' WHEN 3 THEN '' ELSE 'minutes' END END AS duration,
         CASE WHEN cancelled AND o.o_orderkey % 2 = 0 THEN 'Restaurant Cancellation'
              WHEN cancelled THEN 'Customer Cancellation'
              WHEN o.o_orderkey % 7 = 0 THEN 'null' WHEN o.o_orderkey % 7 = 1 THEN '' ELSE NULL END AS cancellation
  FROM (SELECT *, (o_orderstatus = 'P' AND o_orderkey % 3 = 0) AS cancelled FROM orders) o)"""

CUSTOMER_ORDERS = f"""customer_orders AS (
  SELECT order_id, customer_id, pizza_id, {_int_list('exclusions')} AS exclusions, {_int_list('extras')} AS extras,
         order_time,
         CAST(ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, pizza_id NULLS FIRST,
              exclusions NULLS FIRST, extras NULLS FIRST, order_time NULLS FIRST) AS INTEGER) AS line_id
  FROM customer_orders_raw)"""

RUNNER_ORDERS = f"""runner_orders AS (
  SELECT order_id, runner_id,
         try_strptime({_null_tok('pickup_time')}, '%Y-%m-%d %H:%M:%S') AS pickup_time,
         {_measure('distance', 'DECIMAL(10,2)')} AS distance,
         {_measure('duration', 'INTEGER')} AS duration,
         {_null_tok('cancellation')} AS cancellation
  FROM runner_orders_raw)"""

DELIVERED = """delivered AS (SELECT * FROM runner_orders WHERE cancellation IS NULL)"""
DELIVERED_LINES = """delivered_lines AS (
  SELECT * FROM customer_orders WHERE order_id IN (SELECT order_id FROM delivered))"""
ORDER_TIMES = """order_times AS (
  SELECT order_id, MIN(order_time) AS order_time, COUNT(*) AS n_items, MIN(customer_id) AS customer_id
  FROM customer_orders GROUP BY order_id)"""
BRIDGE = f"""recipe_bridge AS (
  SELECT pizza_id, unnest({_int_list('toppings')}) AS topping_id FROM pizza_recipes)"""

PIZZA = [ORDERS_RAW, RUNNER_RAW, CUSTOMER_ORDERS, RUNNER_ORDERS, DELIVERED, DELIVERED_LINES]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _pizza_price(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return f"(CASE WHEN {p}pizza_id % 2 = 1 THEN 12 ELSE 10 END)"


def _n_pizza_cols() -> str:
    return ", ".join(f"COUNT(*) FILTER (WHERE pizza_id = {i}) AS n_pizza_{i}" for i in range(1, N_PIZZAS + 1))


SPECIAL = ", ".join(f"'{s}'" for s in C.SPECIAL_ITEMS)

# how often a line uses each topping of the dictionary: once if its recipe has it and the
# customer did not leave it out, and once more for each time it is listed as an extra
TOPPING_USES = f"""topping_uses AS (
  SELECT c.order_id, c.line_id, c.pizza_id, t.topping_id, t.topping_name,
         CAST(list_contains(r.base, t.topping_id) AND NOT COALESCE(list_contains(c.exclusions, t.topping_id), FALSE) AS INTEGER)
         + len(list_filter(COALESCE(c.extras, []), lambda e: e = t.topping_id)) AS uses
  FROM {{lines}} c JOIN (SELECT pizza_id, {_int_list('toppings')} AS base FROM pizza_recipes) r ON r.pizza_id = c.pizza_id
  CROSS JOIN pizza_toppings t)"""


ORACLE: dict[str, str] = {
    # ------------------------------------------------------------------ restaurant
    "spend_per_customer": _with(SALES, MENU) + """
SELECT s.customer_id, COUNT(*) AS n_items, CAST(SUM(m.price) AS DECIMAL(18,2)) AS total_spend
FROM sales s LEFT JOIN menu m ON s.product_id = m.product_id
WHERE s.customer_id IS NOT NULL GROUP BY s.customer_id""",

    "visit_days_per_customer": _with(SALES) + """
SELECT customer_id, COUNT(DISTINCT order_date) AS n_visit_days, COUNT(*) AS n_purchases FROM sales GROUP BY customer_id""",

    "first_item_per_customer": _with(SALES, MENU) + """
SELECT f.customer_id, f.order_date, f.product_id, m.product_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date, product_id) AS rn FROM sales) f
LEFT JOIN menu m ON f.product_id = m.product_id WHERE f.rn = 1""",

    "first_day_items_all_ties": _with(SALES) + """
SELECT DISTINCT customer_id, order_date, product_id
FROM (SELECT *, RANK() OVER (PARTITION BY customer_id ORDER BY order_date) AS rk FROM sales) WHERE rk = 1""",

    "most_purchased_item": _with(SALES, MENU) + """
SELECT t.product_id, m.product_name, t.n_bought
FROM (SELECT product_id, COUNT(*) AS n_bought FROM sales GROUP BY product_id ORDER BY n_bought DESC, product_id LIMIT 1) t
LEFT JOIN menu m ON t.product_id = m.product_id""",

    "favourite_item_per_customer": _with(SALES) + """
SELECT customer_id, product_id, n_bought FROM (
  SELECT customer_id, product_id, n_bought,
         ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY n_bought DESC, product_id) AS rn
  FROM (SELECT customer_id, product_id, COUNT(*) AS n_bought FROM sales GROUP BY customer_id, product_id))
WHERE rn = 1""",

    "favourite_items_all_ties": _with(SALES) + """
SELECT customer_id, product_id, n_bought FROM (
  SELECT customer_id, product_id, n_bought, RANK() OVER (PARTITION BY customer_id ORDER BY n_bought DESC) AS rk
  FROM (SELECT customer_id, product_id, COUNT(*) AS n_bought FROM sales GROUP BY customer_id, product_id))
WHERE rk = 1""",

    "first_item_after_joining": _with(SALES, MEMBERS) + """
SELECT customer_id, order_date, product_id FROM (
  SELECT s.customer_id, s.order_date, s.product_id,
         ROW_NUMBER() OVER (PARTITION BY s.customer_id ORDER BY s.order_date, s.product_id) AS rn
  FROM sales s JOIN members m ON s.customer_id = m.customer_id WHERE s.order_date > m.join_date)
WHERE rn = 1""",

    "last_item_before_joining": _with(SALES, MEMBERS) + """
SELECT customer_id, order_date, product_id FROM (
  SELECT s.customer_id, s.order_date, s.product_id,
         ROW_NUMBER() OVER (PARTITION BY s.customer_id ORDER BY s.order_date DESC, s.product_id DESC) AS rn
  FROM sales s JOIN members m ON s.customer_id = m.customer_id WHERE s.order_date < m.join_date)
WHERE rn = 1""",

    "spend_before_joining": _with(SALES, MENU, MEMBERS) + """
SELECT s.customer_id, COUNT(*) AS n_items, CAST(SUM(p.price) AS DECIMAL(18,2)) AS amount_spent
FROM sales s JOIN members m ON s.customer_id = m.customer_id LEFT JOIN menu p ON s.product_id = p.product_id
WHERE s.order_date < m.join_date GROUP BY s.customer_id""",

    "loyalty_points": _with(SALES, MENU) + f"""
SELECT s.customer_id,
       CAST(SUM(m.price * 10 * CASE WHEN m.product_name IN ({SPECIAL}) THEN 2 ELSE 1 END) AS DECIMAL(18,2)) AS points
FROM sales s JOIN menu m ON s.product_id = m.product_id GROUP BY s.customer_id""",

    "loyalty_points_first_week": _with(SALES, MENU, MEMBERS) + f"""
SELECT s.customer_id,
       CAST(SUM(m.price * 10 * CASE WHEN s.order_date >= j.join_date AND s.order_date < j.join_date + 7 THEN 2
                                    WHEN m.product_name IN ({SPECIAL}) THEN 2 ELSE 1 END) AS DECIMAL(18,2)) AS points
FROM sales s JOIN menu m ON s.product_id = m.product_id JOIN members j ON s.customer_id = j.customer_id
WHERE s.order_date <= DATE '{C.POINTS_UNTIL}' GROUP BY s.customer_id""",

    "loyalty_points_eight_day_window": _with(SALES, MENU, MEMBERS) + f"""
SELECT s.customer_id,
       CAST(SUM(m.price * 10 * CASE WHEN s.order_date >= j.join_date AND s.order_date <= j.join_date + 7 THEN 2
                                    WHEN m.product_name IN ({SPECIAL}) THEN 2 ELSE 1 END) AS DECIMAL(18,2)) AS points
FROM sales s JOIN menu m ON s.product_id = m.product_id JOIN members j ON s.customer_id = j.customer_id
GROUP BY s.customer_id""",

    # ------------------------------------------------------------------ delivery
    "order_counts": _with(ORDERS_RAW) + """
SELECT COUNT(*) AS n_lines, COUNT(DISTINCT order_id) AS n_orders FROM customer_orders_raw""",

    "delivered_orders_per_runner": _with(RUNNER_RAW, RUNNER_ORDERS, DELIVERED) + """
SELECT runner_id, COUNT(DISTINCT order_id) AS n_delivered FROM delivered GROUP BY runner_id""",

    "delivered_items_per_pizza": _with(*PIZZA, PIZZA_NAMES) + """
SELECT n.pizza_name, COUNT(*) AS n_delivered FROM delivered_lines l JOIN pizza_names n ON l.pizza_id = n.pizza_id
GROUP BY n.pizza_name""",

    "pizzas_per_customer_pivot": _with(ORDERS_RAW) + f"""
SELECT customer_id, {_n_pizza_cols()} FROM customer_orders_raw GROUP BY customer_id""",

    "largest_delivered_order": _with(*PIZZA) + """
SELECT order_id, COUNT(*) AS n_items FROM delivered_lines GROUP BY order_id ORDER BY n_items DESC, order_id LIMIT 1""",

    "change_flags_per_customer": _with(*PIZZA) + """
SELECT customer_id,
       COUNT(*) FILTER (WHERE COALESCE(len(exclusions), 0) > 0 OR COALESCE(len(extras), 0) > 0) AS n_changed,
       COUNT(*) FILTER (WHERE NOT (COALESCE(len(exclusions), 0) > 0 OR COALESCE(len(extras), 0) > 0)) AS n_unchanged,
       COUNT(*) FILTER (WHERE COALESCE(len(exclusions), 0) > 0 AND COALESCE(len(extras), 0) > 0) AS n_both_changed
FROM delivered_lines GROUP BY customer_id""",

    "change_counts_full_join": _with(*PIZZA) + """
SELECT customer_id, COALESCE(a.n_changed, 0) AS n_changed, COALESCE(b.n_unchanged, 0) AS n_unchanged
FROM (SELECT customer_id, COUNT(*) AS n_changed FROM delivered_lines
      WHERE COALESCE(len(exclusions), 0) > 0 OR COALESCE(len(extras), 0) > 0 GROUP BY customer_id) a
FULL OUTER JOIN
     (SELECT customer_id, COUNT(*) AS n_unchanged FROM delivered_lines
      WHERE NOT (COALESCE(len(exclusions), 0) > 0 OR COALESCE(len(extras), 0) > 0) GROUP BY customer_id) b
USING (customer_id)""",

    "volume_by_hour": _with(ORDERS_RAW) + """
SELECT CAST(hour(order_time) AS INTEGER) AS hour_of_day, COUNT(*) AS n_items FROM customer_orders_raw GROUP BY 1""",

    "volume_by_weekday": _with(ORDERS_RAW) + """
SELECT CAST(isodow(order_time) AS INTEGER) AS iso_weekday, COUNT(*) AS n_items FROM customer_orders_raw GROUP BY 1""",

    "clean_runner_orders": _with(RUNNER_RAW, RUNNER_ORDERS) + """
SELECT order_id, runner_id, pickup_time, distance, duration, cancellation FROM runner_orders""",

    "clean_customer_orders": _with(ORDERS_RAW, CUSTOMER_ORDERS) + """
SELECT order_id, customer_id, pizza_id, array_to_string(exclusions, ',') AS exclusions,
       array_to_string(extras, ',') AS extras, order_time, line_id
FROM customer_orders""",

    "recipe_bridge": _with(PIZZA_NAMES, PIZZA_RECIPES, BRIDGE) + """
SELECT pizza_id, topping_id FROM recipe_bridge""",

    "runner_signups_per_week": """
SELECT CAST(ceil(dayofyear(DATE '2021-01-01' + CAST(c_custkey % 365 AS INTEGER)) / 7.0) AS INTEGER) AS week_of_year,
       COUNT(*) AS n_runners
FROM customer GROUP BY 1""",

    "pickup_minutes_per_runner": _with(*PIZZA, ORDER_TIMES) + """
SELECT d.runner_id,
       AVG(date_diff('minute', t.order_time, d.pickup_time)) AS pickup_minutes_avg,
       CAST(MIN(date_diff('minute', t.order_time, d.pickup_time)) AS INTEGER) AS pickup_minutes_min,
       CAST(MAX(date_diff('minute', t.order_time, d.pickup_time)) AS INTEGER) AS pickup_minutes_max,
       CAST(MAX(date_diff('minute', t.order_time, d.pickup_time)) - MIN(date_diff('minute', t.order_time, d.pickup_time)) AS INTEGER) AS pickup_minutes_range
FROM order_times t JOIN delivered d ON t.order_id = d.order_id GROUP BY d.runner_id""",

    "prep_minutes_by_items": _with(*PIZZA, ORDER_TIMES) + """
SELECT t.n_items, COUNT(*) AS n_orders, AVG(date_diff('minute', t.order_time, d.pickup_time)) AS avg_prep_minutes
FROM order_times t JOIN delivered d ON t.order_id = d.order_id GROUP BY t.n_items""",

    "avg_distance_per_customer": _with(*PIZZA, ORDER_TIMES) + """
SELECT t.customer_id,
       CAST(CAST((CAST(SUM(d.distance) * 100 AS BIGINT) * 200 + COUNT(*)) // (2 * COUNT(*)) AS DECIMAL(18,0)) * 0.0001
            AS DECIMAL(12,4)) AS avg_distance_km
FROM order_times t JOIN delivered d ON t.order_id = d.order_id GROUP BY t.customer_id""",

    "delivery_duration_range": _with(RUNNER_RAW, RUNNER_ORDERS, DELIVERED) + """
SELECT MIN(duration) AS min_duration, MAX(duration) AS max_duration, MAX(duration) - MIN(duration) AS duration_range
FROM delivered""",

    "avg_speed_per_runner": _with(RUNNER_RAW, RUNNER_ORDERS, DELIVERED) + """
SELECT runner_id, ROUND(AVG(CAST(distance AS DOUBLE) / NULLIF(CAST(duration AS DOUBLE), 0) * 60.0), 2) AS avg_speed_kmh
FROM delivered GROUP BY runner_id""",

    "success_rate_per_runner": _with(RUNNER_RAW, RUNNER_ORDERS) + """
SELECT runner_id, COUNT(*) FILTER (WHERE cancellation IS NULL) AS n_delivered, COUNT(*) AS n_orders,
       ROUND(COUNT(*) FILTER (WHERE cancellation IS NULL) * 100.0 / COUNT(*), 1) AS pct_delivered
FROM runner_orders GROUP BY runner_id""",

    "recipe_ingredients": _with(PIZZA_NAMES, PIZZA_RECIPES, BRIDGE, TOPPINGS_CTE) + """
SELECT n.pizza_name, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS ingredients
FROM recipe_bridge b JOIN pizza_toppings t ON b.topping_id = t.topping_id JOIN pizza_names n ON b.pizza_id = n.pizza_id
GROUP BY n.pizza_name""",

    "most_common_extra": _with(ORDERS_RAW, CUSTOMER_ORDERS, TOPPINGS_CTE) + """
SELECT c.topping_id, t.topping_name, c.n
FROM (SELECT topping_id, COUNT(*) AS n FROM (SELECT unnest(extras) AS topping_id FROM customer_orders)
      GROUP BY topping_id ORDER BY n DESC, topping_id LIMIT 1) c
JOIN pizza_toppings t ON c.topping_id = t.topping_id""",

    "most_common_exclusion": _with(ORDERS_RAW, CUSTOMER_ORDERS, TOPPINGS_CTE) + """
SELECT c.topping_id, t.topping_name, c.n
FROM (SELECT topping_id, COUNT(*) AS n FROM (SELECT unnest(exclusions) AS topping_id FROM customer_orders)
      GROUP BY topping_id ORDER BY n DESC, topping_id LIMIT 1) c
JOIN pizza_toppings t ON c.topping_id = t.topping_id""",

    "order_line_labels": _with(ORDERS_RAW, CUSTOMER_ORDERS, PIZZA_NAMES, TOPPINGS_CTE) + """,
ex AS (SELECT u.order_id, u.line_id, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS txt
       FROM (SELECT order_id, line_id, unnest(exclusions) AS topping_id FROM customer_orders) u
       JOIN pizza_toppings t ON u.topping_id = t.topping_id GROUP BY u.order_id, u.line_id),
xt AS (SELECT u.order_id, u.line_id, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS txt
       FROM (SELECT order_id, line_id, unnest(extras) AS topping_id FROM customer_orders) u
       JOIN pizza_toppings t ON u.topping_id = t.topping_id GROUP BY u.order_id, u.line_id)
SELECT c.order_id, c.line_id,
       n.pizza_name || COALESCE(' - Exclude ' || ex.txt, '') || COALESCE(' - Extra ' || xt.txt, '') AS label
FROM customer_orders c JOIN pizza_names n ON c.pizza_id = n.pizza_id
LEFT JOIN ex ON c.order_id = ex.order_id AND c.line_id = ex.line_id
LEFT JOIN xt ON c.order_id = xt.order_id AND c.line_id = xt.line_id""".replace("\n,\nex AS", ",\nex AS"),

    "ingredient_bill": _with(ORDERS_RAW, CUSTOMER_ORDERS, PIZZA_NAMES, PIZZA_RECIPES, TOPPINGS_CTE,
                             TOPPING_USES.format(lines="customer_orders")) + """,
bills AS (SELECT order_id, line_id, pizza_id, list({'name': topping_name, 'uses': uses} ORDER BY topping_name) FILTER (WHERE uses > 0) AS parts
          FROM topping_uses GROUP BY order_id, line_id, pizza_id)
SELECT order_id, line_id,
       pizza_name || ': ' || array_to_string(list_transform(parts, lambda p: concat(CASE WHEN p.uses > 1 THEN concat(p.uses, 'x') END, p.name)), ', ') AS ingredient_list
FROM bills JOIN pizza_names USING (pizza_id)""",

    "ingredient_usage_delivered": _with(*PIZZA, PIZZA_NAMES, PIZZA_RECIPES, TOPPINGS_CTE,
                                        TOPPING_USES.format(lines="delivered_lines")) + """
SELECT topping_id, CAST(SUM(uses) AS BIGINT) AS n_used, topping_name FROM topping_uses
GROUP BY topping_id, topping_name HAVING SUM(uses) > 0""",

    "revenue_by_delivery_status": _with(ORDERS_RAW, RUNNER_RAW, CUSTOMER_ORDERS, RUNNER_ORDERS) + f"""
SELECT r.cancellation IS NULL AS delivered,
       CAST(SUM({_pizza_price('c')}) AS BIGINT) AS revenue,
       CAST(SUM({_pizza_price('c')} + 1 * COALESCE(len(c.extras), 0)) AS BIGINT) AS revenue_with_extras
FROM customer_orders c JOIN runner_orders r ON c.order_id = r.order_id GROUP BY 1""",

    "net_revenue_after_distance_cost": _with(*PIZZA) + f""",
rev AS (SELECT CAST(SUM({_pizza_price()}) AS BIGINT) AS revenue FROM delivered_lines),
km AS (SELECT SUM(distance) AS km FROM delivered)
SELECT rev.revenue, CAST(km.km * 0.30 AS DECIMAL(18,2)) AS delivery_cost,
       CAST(rev.revenue - km.km * 0.30 AS DECIMAL(18,2)) AS net_revenue
FROM rev, km""",

    "delivery_report": _with(*PIZZA, ORDER_TIMES) + """
SELECT t.customer_id, t.order_id, d.runner_id, CAST(d.order_id % 5 + 1 AS INTEGER) AS rating,
       t.order_time, d.pickup_time,
       CAST(date_diff('minute', t.order_time, d.pickup_time) AS INTEGER) AS minutes_to_pickup,
       d.duration AS delivery_duration,
       ROUND(CAST(d.distance AS DOUBLE) / NULLIF(CAST(d.duration AS DOUBLE), 0) * 60.0, 2) AS avg_speed_kmh,
       t.n_items
FROM order_times t JOIN delivered d ON t.order_id = d.order_id""",

    # ------------------------------------------------------------------ subscriptions
    "customer_count": _with(SUBS) + "SELECT COUNT(DISTINCT customer_id) AS n_customers FROM subscriptions",

    "trial_starts_per_month": _with(SUBS) + """
SELECT strftime(start_date, '%Y-%m') AS month, COUNT(*) AS n_trials FROM subscriptions WHERE plan_id = 0 GROUP BY 1""",

    "plan_starts_after_year": _with(SUBS, PLANS_CTE) + f"""
SELECT p.plan_name, strftime(s.start_date, '%Y-%m') AS month, COUNT(*) AS n_events
FROM subscriptions s JOIN plans p ON s.plan_id = p.plan_id WHERE year(s.start_date) > {C.REPORT_YEAR} GROUP BY 1, 2""",

    "churn_share": _with(SUBS) + """
SELECT COUNT(DISTINCT CASE WHEN plan_id = 4 THEN customer_id END) AS n_churned, COUNT(DISTINCT customer_id) AS n_customers,
       ROUND(COUNT(DISTINCT CASE WHEN plan_id = 4 THEN customer_id END) * 100.0 / COUNT(DISTINCT customer_id), 1) AS pct_churned
FROM subscriptions""",

    "churn_share_of_rows": _with(SUBS) + """
SELECT COUNT(*) FILTER (WHERE plan_id = 4) AS n_churn_rows, COUNT(*) AS n_rows,
       ROUND(COUNT(*) FILTER (WHERE plan_id = 4) * 100.0 / COUNT(*), 1) AS pct_of_rows
FROM subscriptions""",

    "churned_without_paid_plan": _with(SUBS) + """,
churners AS (SELECT DISTINCT customer_id FROM subscriptions WHERE plan_id = 4),
straight AS (SELECT customer_id FROM churners
             WHERE customer_id NOT IN (SELECT customer_id FROM subscriptions WHERE plan_id IN (1, 2, 3)))
SELECT (SELECT COUNT(*) FROM straight) AS n_churned_straight, (SELECT COUNT(*) FROM churners) AS n_churners,
       ROUND((SELECT COUNT(*) FROM straight) * 100.0 / (SELECT COUNT(*) FROM churners), 1) AS pct_of_churners""",

    "churned_without_paid_plan_joins": _with(SUBS) + """
SELECT COUNT(DISTINCT customer_id) AS n_churned_straight FROM subscriptions
WHERE customer_id IN (SELECT customer_id FROM subscriptions WHERE plan_id = 4)
  AND customer_id NOT IN (SELECT customer_id FROM subscriptions WHERE plan_id IN (1, 2, 3))""",

    "churn_right_after_trial": _with(SUBS) + """
SELECT COUNT(*) FILTER (WHERE prev_plan = 0 AND plan_id = 4) AS n_churned_after_trial, COUNT(DISTINCT customer_id) AS n_customers,
       ROUND(COUNT(*) FILTER (WHERE prev_plan = 0 AND plan_id = 4) * 100.0 / COUNT(DISTINCT customer_id), 1) AS pct_of_customers
FROM (SELECT *, LAG(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, sub_seq) AS prev_plan FROM subscriptions)""",

    "plan_after_trial": _with(SUBS) + """,
nxt AS (SELECT plan_id, LEAD(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, sub_seq) AS next_plan_id
        FROM subscriptions),
trial AS (SELECT * FROM nxt WHERE plan_id = 0 AND next_plan_id IS NOT NULL)
SELECT next_plan_id, COUNT(*) AS n, (SELECT COUNT(*) FROM trial) AS n_trials_with_next,
       ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM trial), 1) AS pct
FROM trial GROUP BY next_plan_id""",

    "plan_mix_at_date": _with(SUBS, PLANS_CTE) + f""",
cur AS (SELECT customer_id, plan_id FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY start_date DESC, sub_seq DESC) AS rn
          FROM subscriptions WHERE start_date <= DATE '{C.PLAN_MIX_DATE}') WHERE rn = 1)
SELECT c.plan_id, p.plan_name, COUNT(*) AS n_customers, (SELECT COUNT(*) FROM cur) AS n_active,
       ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM cur), 1) AS pct
FROM cur c JOIN plans p ON c.plan_id = p.plan_id GROUP BY c.plan_id, p.plan_name""",

    "plan_mix_before_date_active": _with(SUBS, PLANS_CTE) + f""",
cur AS (SELECT customer_id, plan_id FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY start_date DESC, sub_seq DESC) AS rn
          FROM subscriptions WHERE start_date < DATE '{C.PLAN_MIX_DATE}') WHERE rn = 1 AND plan_id <> 4)
SELECT c.plan_id, p.plan_name, COUNT(*) AS n_customers, (SELECT COUNT(*) FROM cur) AS n_active,
       ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM cur), 1) AS pct
FROM cur c JOIN plans p ON c.plan_id = p.plan_id GROUP BY c.plan_id, p.plan_name""",

    "annual_upgrades_in_year": _with(SUBS) + f"""
SELECT COUNT(DISTINCT customer_id) AS n_customers FROM subscriptions WHERE plan_id = 3 AND year(start_date) = {C.REPORT_YEAR}""",

    "avg_days_to_annual": _with(SUBS) + """,
t AS (SELECT a.customer_id, a.d3 - j.d0 AS days
      FROM (SELECT customer_id, MIN(start_date) AS d3 FROM subscriptions WHERE plan_id = 3 GROUP BY customer_id) a
      JOIN (SELECT customer_id, MIN(start_date) AS d0 FROM subscriptions WHERE plan_id = 0 GROUP BY customer_id) j
      ON a.customer_id = j.customer_id WHERE a.d3 >= j.d0)
SELECT AVG(days) AS avg_days, COUNT(*) AS n_customers FROM t""",

    "days_to_annual_buckets": _with(SUBS) + """,
t AS (SELECT a.customer_id, a.d3 - j.d0 AS days
      FROM (SELECT customer_id, MIN(start_date) AS d3 FROM subscriptions WHERE plan_id = 3 GROUP BY customer_id) a
      JOIN (SELECT customer_id, MIN(start_date) AS d0 FROM subscriptions WHERE plan_id = 0 GROUP BY customer_id) j
      ON a.customer_id = j.customer_id WHERE a.d3 >= j.d0),
b AS (SELECT CAST(greatest(ceil(days / 30.0), 1) AS INTEGER) AS bucket FROM t)
SELECT bucket, CAST(CASE WHEN bucket = 1 THEN 0 ELSE (bucket - 1) * 30 + 1 END AS VARCHAR) || '-' || CAST(bucket * 30 AS VARCHAR) || ' days' AS days_range,
       COUNT(*) AS n_customers
FROM b GROUP BY bucket""",

    "days_to_annual_buckets_capped": _with(SUBS) + """,
t AS (SELECT a.customer_id, a.d3 - j.d0 AS days
      FROM (SELECT customer_id, MIN(start_date) AS d3 FROM subscriptions WHERE plan_id = 3 GROUP BY customer_id) a
      JOIN (SELECT customer_id, MIN(start_date) AS d0 FROM subscriptions WHERE plan_id = 0 GROUP BY customer_id) j
      ON a.customer_id = j.customer_id WHERE a.d3 >= j.d0),
b AS (SELECT CAST(least(greatest(ceil(days / 30.0), 1), 7) AS INTEGER) AS bucket FROM t)
SELECT bucket,
       CASE WHEN bucket = 7 THEN '180+ days'
            ELSE CAST(CASE WHEN bucket = 1 THEN 0 ELSE (bucket - 1) * 30 + 1 END AS VARCHAR) || '-' || CAST(bucket * 30 AS VARCHAR) || ' days' END AS days_range,
       COUNT(*) AS n_customers
FROM b GROUP BY bucket""",

    "downgrades_in_year": _with(SUBS) + f"""
SELECT COUNT(*) FILTER (WHERE prev_plan = 2 AND plan_id = 1 AND year(start_date) = {C.REPORT_YEAR}) AS n_downgrades
FROM (SELECT *, LAG(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, sub_seq) AS prev_plan FROM subscriptions)""",

    "payment_ledger": "WITH RECURSIVE " + ",\n".join([SUBS, PLANS_CTE]) + f""",
nxt AS (SELECT customer_id, plan_id, start_date, sub_seq,
               LEAD(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, sub_seq) AS next_start
        FROM subscriptions),
paid AS (SELECT customer_id, plan_id, sub_seq, start_date,
                COALESCE(next_start, DATE '{C.BILLING_HORIZON}') AS end_date,
                CASE WHEN plan_id = 3 THEN 12 ELSE 1 END AS step
         FROM nxt WHERE plan_id IN (1, 2, 3)),
pay(customer_id, plan_id, sub_seq, pos, payment_date, end_date, step) AS (
  SELECT customer_id, plan_id, sub_seq, 0, start_date, end_date, step FROM paid
  UNION ALL
  SELECT customer_id, plan_id, sub_seq, pos + 1, CAST(payment_date + to_months(step) AS DATE), end_date, step
  FROM pay WHERE CAST(payment_date + to_months(step) AS DATE) < end_date)
SELECT p.customer_id, p.plan_id, p.payment_date,
       CAST(CASE WHEN p.plan_id IN (2, 3)
                      AND LAG(p.plan_id) OVER (PARTITION BY p.customer_id ORDER BY p.payment_date, p.sub_seq, p.pos) = 1
                 THEN pl.price - 9.90 ELSE pl.price END AS DECIMAL(5,2)) AS amount_paid
FROM pay p JOIN plans pl ON p.plan_id = pl.plan_id""",

    "monthly_renewal_dates": "WITH RECURSIVE " + SUBS + f""",
nxt AS (SELECT customer_id, plan_id, start_date,
               COALESCE(LEAD(start_date) OVER (PARTITION BY customer_id ORDER BY start_date, sub_seq),
                        DATE '{C.BILLING_HORIZON}') AS end_date
        FROM subscriptions),
r(customer_id, plan_id, renewal_date, end_date) AS (
  SELECT customer_id, plan_id, start_date, end_date FROM nxt WHERE plan_id IN (1, 2, 3)
  UNION ALL
  SELECT customer_id, plan_id, CAST(renewal_date + INTERVAL 1 MONTH AS DATE), end_date
  FROM r WHERE CAST(renewal_date + INTERVAL 1 MONTH AS DATE) < end_date)
SELECT customer_id, plan_id, renewal_date FROM r""",

    # ------------------------------------------------------------------ bank
    "unique_nodes": _with(NODES) + "SELECT COUNT(DISTINCT node_id) AS n_nodes FROM customer_nodes",

    "nodes_and_customers_per_region": _with(REGIONS, NODES) + """
SELECT r.region_name, COUNT(DISTINCT n.node_id) AS n_nodes, COUNT(DISTINCT n.customer_id) AS n_customers
FROM regions r LEFT JOIN customer_nodes n ON r.region_id = n.region_id GROUP BY r.region_name""",

    "reallocation_days": _with(NODES) + """
SELECT AVG(days) AS avg_days, ROUND(quantile_cont(days, 0.5), 4) AS p50_days,
       ROUND(quantile_cont(days, 0.8), 4) AS p80_days, ROUND(quantile_cont(days, 0.95), 4) AS p95_days
FROM (SELECT end_date - start_date AS days FROM customer_nodes WHERE end_date <> DATE '9999-12-31')""",

    "reallocation_days_by_region": _with(REGIONS, NODES) + """
SELECT r.region_name, AVG(d.days) AS avg_days, ROUND(quantile_cont(d.days, 0.5), 4) AS p50_days,
       ROUND(quantile_cont(d.days, 0.8), 4) AS p80_days, ROUND(quantile_cont(d.days, 0.95), 4) AS p95_days
FROM regions r LEFT JOIN (SELECT region_id, CASE WHEN end_date <> DATE '9999-12-31' THEN end_date - start_date END AS days
                          FROM customer_nodes) d ON r.region_id = d.region_id
GROUP BY r.region_name""",

    "transaction_type_summary": _with(TXNS) + """
SELECT txn_type, COUNT(DISTINCT customer_id) AS n_customers, COUNT(*) AS n_txns,
       CAST(SUM(txn_amount) AS DECIMAL(18,2)) AS total_amount
FROM customer_transactions GROUP BY txn_type""",

    "avg_deposits_per_customer": _with(TXNS) + """
SELECT AVG(n) AS avg_deposit_count, ROUND(AVG(CAST(amt AS DOUBLE)), 2) AS avg_deposit_amount
FROM (SELECT customer_id, COUNT(*) FILTER (WHERE txn_type = 'deposit') AS n,
             SUM(CASE WHEN txn_type = 'deposit' THEN txn_amount ELSE 0 END) AS amt
      FROM customer_transactions GROUP BY customer_id)""",

    "active_customers_per_month": _with(TXNS) + """
SELECT month, COUNT(*) FILTER (WHERE n_dep >= 2 AND (n_pur >= 1 OR n_wd >= 1)) AS n_customers
FROM (SELECT strftime(txn_date, '%Y-%m') AS month, customer_id,
             COUNT(*) FILTER (WHERE txn_type = 'deposit') AS n_dep, COUNT(*) FILTER (WHERE txn_type = 'purchase') AS n_pur,
             COUNT(*) FILTER (WHERE txn_type = 'withdrawal') AS n_wd
      FROM customer_transactions GROUP BY 1, 2)
GROUP BY month""",

    "monthly_closing_balance": _with(TXNS) + """,
net AS (SELECT customer_id, strftime(txn_date, '%Y-%m') AS month,
               CAST(coalesce(SUM(txn_amount) FILTER (WHERE txn_type = 'deposit'), 0)
               - coalesce(SUM(txn_amount) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')), 0) AS DECIMAL(18,2)) AS net
        FROM customer_transactions GROUP BY 1, 2)
SELECT customer_id, month, net,
       CAST(SUM(net) OVER (PARTITION BY customer_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance
FROM net""",

    "monthly_closing_balance_filled": _with(TXNS) + """,
net AS (SELECT customer_id, strftime(txn_date, '%Y-%m') AS month,
               CAST(coalesce(SUM(txn_amount) FILTER (WHERE txn_type = 'deposit'), 0)
               - coalesce(SUM(txn_amount) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')), 0) AS DECIMAL(18,2)) AS net
        FROM customer_transactions GROUP BY 1, 2),
bal AS (SELECT customer_id, month,
               CAST(SUM(net) OVER (PARTITION BY customer_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance
        FROM net),
grid AS (SELECT customer_id,
                strftime(unnest(generate_series(CAST(MIN(month) || '-01' AS DATE),
                                                (SELECT CAST(MAX(month) || '-01' AS DATE) FROM net),
                                                INTERVAL 1 MONTH)), '%Y-%m') AS month
         FROM net GROUP BY customer_id)
SELECT g.customer_id, g.month,
       LAST_VALUE(b.balance IGNORE NULLS) OVER (PARTITION BY g.customer_id ORDER BY g.month
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
FROM grid g LEFT JOIN bal b ON g.customer_id = b.customer_id AND g.month = b.month""",

    "balance_growth_active_months": _with(TXNS) + """,
net AS (SELECT customer_id, strftime(txn_date, '%Y-%m') AS month,
               CAST(coalesce(SUM(txn_amount) FILTER (WHERE txn_type = 'deposit'), 0)
               - coalesce(SUM(txn_amount) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')), 0) AS DECIMAL(18,2)) AS net
        FROM customer_transactions GROUP BY 1, 2),
bal AS (SELECT customer_id, month,
               CAST(SUM(net) OVER (PARTITION BY customer_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS balance
        FROM net),
g AS (SELECT month, balance, LAG(balance) OVER (PARTITION BY customer_id ORDER BY month) AS prev FROM bal)
SELECT month,
       COUNT(*) FILTER (WHERE prev <> 0 AND balance - prev > 0.05 * abs(prev)) AS n_grew,
       COUNT(*) AS n_customers,
       ROUND(COUNT(*) FILTER (WHERE prev <> 0 AND balance - prev > 0.05 * abs(prev)) * 100.0 / COUNT(*), 1) AS pct_grew
FROM g GROUP BY month""",
}

# Daily balances, from the question: on each day from a customer's first transaction to
# the end of the last month, the sum of all that was moved on or before it.
DAILY = _with(EVENT_TXNS) + """,
moved AS (SELECT customer_id, txn_date,
                 coalesce(SUM(txn_amount) FILTER (WHERE txn_type = 'deposit'), 0)
                 - coalesce(SUM(txn_amount) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')), 0) AS amount
          FROM event_txns GROUP BY customer_id, txn_date),
days AS (SELECT customer_id,
                CAST(unnest(generate_series(MIN(txn_date), (SELECT last_day(MAX(txn_date)) FROM event_txns), INTERVAL 1 DAY)) AS DATE) AS bal_date
         FROM event_txns GROUP BY customer_id),
daily AS (SELECT days.customer_id, bal_date,
                 CAST(SUM(coalesce(amount, 0)) OVER (PARTITION BY days.customer_id ORDER BY bal_date) AS DECIMAL(18,2)) AS balance
          FROM days LEFT JOIN moved ON moved.customer_id = days.customer_id AND moved.txn_date = days.bal_date)
"""

ORACLE.update({
    "daily_balances": DAILY + "SELECT customer_id, bal_date, balance FROM daily",

    "allocation_month_end": DAILY + """
SELECT month, CAST(SUM(greatest(balance, 0)) AS DECIMAL(18,2)) AS data_required
FROM (SELECT strftime(bal_date, '%Y-%m') AS month, balance,
             ROW_NUMBER() OVER (PARTITION BY customer_id, strftime(bal_date, '%Y-%m') ORDER BY bal_date DESC) AS rn
      FROM daily) WHERE rn = 1 GROUP BY month""",

    "allocation_trailing_30": DAILY + """,
tr AS (SELECT bal_date,
              CAST(SUM(balance) OVER w / COUNT(*) OVER w AS DECIMAL(24,6)) AS avg_bal
       FROM daily WINDOW w AS (PARTITION BY customer_id ORDER BY bal_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
per_day AS (SELECT bal_date, SUM(avg_bal) AS total FROM tr WHERE avg_bal > 0 GROUP BY bal_date)
SELECT CAST(MIN(total) AS DECIMAL(18,2)) AS daily_min, ROUND(AVG(CAST(total AS DOUBLE)), 2) AS daily_avg,
       CAST(MAX(total) AS DECIMAL(18,2)) AS daily_max FROM per_day""",

    "allocation_realtime": DAILY + """,
per_day AS (SELECT bal_date, SUM(balance) AS total FROM daily WHERE balance > 0 GROUP BY bal_date)
SELECT CAST(MIN(total) AS DECIMAL(18,2)) AS daily_min, ROUND(AVG(CAST(total AS DOUBLE)), 2) AS daily_avg,
       CAST(MAX(total) AS DECIMAL(18,2)) AS daily_max FROM per_day""",

    "interest_accrual": DAILY + """
SELECT customer_id, bal_date, balance,
       ROUND(CAST(balance AS DOUBLE) * (1.0 + CAST(0.06 AS DOUBLE) / CAST(365 AS DOUBLE)), 2) AS data_allocation
FROM daily""",

    "monthly_closing_balance_sql": None,  # filled below (same answer as monthly_closing_balance)
    "ingredient_usage_set_ops": None,  # filled below (same answer as ingredient_usage_delivered)
})
ORACLE["ingredient_usage_set_ops"] = ORACLE["ingredient_usage_delivered"]
_BY_MONTH = """
SELECT strftime(bal_date, '%Y-%m') AS month, MIN(total) AS daily_min,
       CAST(SUM(total) AS DOUBLE) / COUNT(*) AS daily_avg, MAX(total) AS daily_max
FROM (SELECT bal_date, CAST(SUM(held) AS DECIMAL(18,2)) AS total FROM held WHERE held > 0 GROUP BY bal_date) GROUP BY 1"""

_MOVES = TXNS + """,
moves AS (SELECT customer_id, txn_date, txn_type, txn_amount,
                 CAST(txn_amount * (CASE WHEN txn_type = 'deposit' THEN 1 ELSE -1 END) AS DECIMAL(12,2)) AS impact
          FROM customer_transactions),
balances AS (SELECT *, CAST(SUM(impact) OVER (PARTITION BY customer_id ORDER BY txn_date, txn_type, txn_amount
                                              ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS balance FROM moves)"""

ORACLE.update({
    "balance_growth_over_5pct": "WITH filled AS (" + ORACLE["monthly_closing_balance_filled"] + """),
pairs AS (SELECT now.month, now.balance, old.balance AS before
          FROM filled now LEFT JOIN filled old ON old.customer_id = now.customer_id
               AND old.month = strftime(CAST(now.month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m'))
SELECT month, COUNT(*) FILTER (WHERE before <> 0 AND balance - before > 0.05 * abs(before)) AS n_grew,
       COUNT(before) AS n_customers,
       ROUND(COUNT(*) FILTER (WHERE before <> 0 AND balance - before > 0.05 * abs(before)) * 100.0 / NULLIF(COUNT(before), 0), 1) AS pct_grew
FROM pairs GROUP BY month""",

    "allocation_previous_month_end": DAILY + """
SELECT strftime(bal_date + 1, '%Y-%m') AS month, CAST(SUM(greatest(balance, 0)) AS DECIMAL(18,2)) AS data_required
FROM daily WHERE bal_date = last_day(bal_date) GROUP BY 1""",

    "allocation_trailing_30_monthly": DAILY + """,
held AS (SELECT bal_date, CAST(SUM(balance) OVER w / COUNT(*) OVER w AS DECIMAL(24,6)) AS held
         FROM daily WINDOW w AS (PARTITION BY customer_id ORDER BY bal_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""" + _BY_MONTH,

    "allocation_realtime_monthly": DAILY + ", held AS (SELECT bal_date, balance AS held FROM daily)" + _BY_MONTH,

    "running_balance_per_transaction": _with(_MOVES) + """
SELECT customer_id, txn_date, txn_type, txn_amount, impact, balance FROM balances""",

    "balance_range_per_customer": _with(_MOVES) + """
SELECT customer_id, MIN(balance) AS min_balance, CAST(SUM(balance) AS DOUBLE) / COUNT(*) AS avg_balance,
       MAX(balance) AS max_balance FROM balances GROUP BY customer_id""",

    "months_with_more_depositors_than_buyers": _with(TXNS) + """
SELECT strftime(txn_date, '%Y-%m') AS month, COUNT(DISTINCT CASE WHEN txn_type = 'deposit' THEN customer_id END) AS n_depositors,
       COUNT(DISTINCT CASE WHEN txn_type = 'purchase' THEN customer_id END) AS n_buyers
FROM customer_transactions GROUP BY 1 HAVING n_depositors > n_buyers""",

    "whole_deposits_per_customer": _with(TXNS) + """
SELECT COUNT(*) FILTER (WHERE txn_type = 'deposit') AS n_deposits, COUNT(DISTINCT customer_id) AS n_customers,
       n_deposits // NULLIF(n_customers, 0) AS deposits_per_customer
FROM customer_transactions""",

    "customer_history": _with(SUBS, TXNS) + """
SELECT customer_id, start_date AS event_date, plan_id, CAST(NULL AS VARCHAR) AS txn_type, CAST(NULL AS DECIMAL(12,2)) AS amount
FROM subscriptions
UNION ALL SELECT customer_id, txn_date, NULL, txn_type, txn_amount FROM customer_transactions""",

    "churn_share_text": "SELECT n_churned, n_customers, format('{:.1f}%', pct_churned) AS churned FROM (" + ORACLE["churn_share"] + ")",

    "days_to_annual_self_join": ORACLE["avg_days_to_annual"],

    "trial_starts_in_order": ORACLE["trial_starts_per_month"] + " ORDER BY month",

    "changed_toppings_per_order": _with(ORDERS_RAW) + f"""
SELECT order_id, unnest({_int_list('exclusions')}) AS topping_id FROM customer_orders_raw
UNION SELECT order_id, unnest({_int_list('extras')}) FROM customer_orders_raw""",
})
ORACLE["monthly_closing_balance_sql"] = ORACLE["monthly_closing_balance"]
ORACLE["ingredient_usage_bits"] = ORACLE["ingredient_usage_delivered"]


def _strict(column: str, kind: str) -> str:
    return f"""SELECT order_id, '{column}' AS column_name, {column} AS text, {_null_tok(column)} IS NULL AS none, TRY_CAST({column} AS {kind}) IS NOT NULL AS fits
  FROM runner_orders_raw"""


CELLS = "cells AS (" + " UNION ALL ".join([_strict("pickup_time", "TIMESTAMP"), _strict("distance", "DECIMAL(10,2)"), _strict("duration", "INTEGER")]) + ")"

ORACLE.update({
    "closing_balances_in_month": DAILY + f"""
SELECT customer_id, balance FROM daily
WHERE strftime(bal_date, '%Y-%m') = '{C.LEDGER_MONTH}' AND bal_date = last_day(bal_date)""",

    # the balance of one day from that of the day before it, one after the other
    "interest_compounded": "WITH RECURSIVE " + TXNS + f""",
moved AS (SELECT customer_id, txn_date, CAST(SUM(CASE txn_type WHEN 'deposit' THEN txn_amount WHEN 'purchase' THEN -txn_amount
                                                                WHEN 'withdrawal' THEN -txn_amount ELSE 0 END) AS DOUBLE) AS net
          FROM customer_transactions GROUP BY customer_id, txn_date),
days AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY txn_date) AS nth FROM moved),
held AS (
  SELECT customer_id, txn_date, nth, net AS balance FROM days WHERE nth = 1
  UNION ALL
  SELECT d.customer_id, d.txn_date, d.nth, h.balance * pow(1.0::DOUBLE + {C.YEARLY_RATE}::DOUBLE / 365, d.txn_date - h.txn_date) + d.net
  FROM held h JOIN days d ON d.customer_id = h.customer_id AND d.nth = h.nth + 1)
SELECT customer_id, txn_date, ROUND(balance, 2) AS balance FROM held""",

    "lines_shipped_per_plan": _with(SUBS) + """,
plan_of_day AS (SELECT customer_id, start_date, arg_max(plan_id, sub_seq) AS plan_id FROM subscriptions GROUP BY ALL HAVING start_date IS NOT NULL),
shipped AS (SELECT o_custkey AS customer_id, CAST(l_shipdate AS DATE) AS ship_date, CAST(l_quantity AS DECIMAL(12,2)) AS quantity
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.customer_id, p.plan_id, COUNT(*) AS n_lines, CAST(SUM(s.quantity) AS DECIMAL(18,2)) AS quantity
FROM shipped s ASOF LEFT JOIN plan_of_day p ON s.customer_id = p.customer_id AND s.ship_date >= p.start_date
GROUP BY s.customer_id, p.plan_id""",

    "event_gap_percentiles": """
SELECT event_type, ROUND(quantile_cont(seconds, 0.5), 4) AS p50_seconds, ROUND(quantile_cont(seconds, 0.8), 4) AS p80_seconds,
       ROUND(quantile_cont(seconds, 0.95), 4) AS p95_seconds
FROM (SELECT event_type, (epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6::DOUBLE AS seconds FROM events)
WHERE seconds IS NOT NULL GROUP BY event_type""",

    "numbered_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_number
FROM lineitem""",

    "customers_kept_by_sketch": _with(TXNS) + """,
active AS (SELECT DISTINCT strftime(txn_date, '%Y-%m') AS month, customer_id FROM customer_transactions)
SELECT a.month, COUNT(*) AS n_customers, COUNT(b.customer_id) AS n_kept, TRUE AS estimate_in_bounds, TRUE AS kept_in_bounds
FROM active a LEFT JOIN active b ON a.customer_id = b.customer_id
     AND b.month = strftime(CAST(a.month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')
GROUP BY a.month""",

    "quantity_per_customer_bucketed": """
SELECT o_custkey AS customer_id, COUNT(*) AS n_lines, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",

    "loyalty_points_flat_bonus": _with(SALES, MENU, MEMBERS) + f"""
SELECT customer_id, CAST(10 * SUM(m.price) + 10 * COUNT(DISTINCT CASE WHEN m.product_name IN ({SPECIAL}) THEN m.product_name END) AS DECIMAL(18,2)) AS points
FROM sales JOIN menu m USING (product_id) JOIN members j USING (customer_id) WHERE order_date >= j.join_date GROUP BY customer_id""",

    "paid_changes_share": _with(SUBS) + """
SELECT SUM(CAST(plan_id BETWEEN 1 AND 3 AS INTEGER))::BIGINT AS n_paid, COUNT(*) AS n_changes, format('{:.2f}%', n_paid * 100.0 / n_changes) AS share
FROM subscriptions WHERE plan_id <> 4""",

    "reallocation_days_with_open": _with(NODES) + """
SELECT AVG(end_date - start_date) AS avg_days, COUNT(*) AS n_allocations, COUNT(*) FILTER (WHERE end_date = DATE '9999-12-31') AS n_open
FROM customer_nodes""",

    "active_customers_two_counts": _with(TXNS) + """
SELECT strftime(txn_date, '%Y-%m') AS month, COUNT(DISTINCT customer_id) FILTER (WHERE txn_type = 'deposit') AS n_depositors,
       COUNT(DISTINCT customer_id) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')) AS n_spenders
FROM customer_transactions GROUP BY 1 HAVING n_depositors > 0 AND n_spenders > 0""",

    "quarantined_cells": _with(RUNNER_RAW, CELLS) + """
SELECT order_id, column_name, CASE column_name WHEN 'pickup_time' THEN 'timestamp_ntz' WHEN 'distance' THEN 'decimal(10,2)' ELSE 'int' END AS wanted_type, text
FROM cells WHERE NOT none AND NOT fits""",

    "conversion_account": _with(RUNNER_RAW, CELLS) + """
SELECT column_name, COUNT(*) FILTER (WHERE none) AS n_empty, COUNT(*) FILTER (WHERE NOT none AND fits) AS n_typed,
       COUNT(*) FILTER (WHERE NOT none AND NOT fits) AS n_quarantined
FROM cells GROUP BY column_name""",
})


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if v}
