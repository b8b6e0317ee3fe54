"""One Spark query per analytical question, on the driver tables under ``sf_dir``.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Outputs use
explicit names and types so the DuckDB oracle (:mod:`casebook.oracle`) can produce
the same columns. Parameters that the questions fix (a special item, a cut-off
date, a horizon) are the module constants below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions.dates import minutes_between, month_key
from casebook.functions.lists import list_size
from casebook.functions.text import percent_text
from casebook.operators import aggregates as AG
from casebook.operators import billing as BI
from casebook.operators import cleaning as CL
from casebook.operators import ledger as LE
from casebook.operators import loyalty as LO
from casebook.operators import ordered as OR
from casebook.operators import recipes as RE
from casebook.operators import sequence as SQ
from casebook.operators import sketches as SK
from casebook.operators.ranges import number_rows
from casebook.operators.selection import quantiles
from casebook.sources import adapters as A
from casebook.sources.io import conform, ensure_database, load_table, stage_table
from casebook.sources.quarantine import account, split_typed
from casebook.sources.stores import replace_partitions, save_bucketed, shared, version
from casebook.sources.tables import read_table, table_path

# Parameters of the questions (chosen for the driver data's date range).
SPECIAL_ITEMS = ("red widget",)
POINTS_UNTIL = "1999-01-31"
PLAN_MIX_DATE = "2000-12-31"
REPORT_YEAR = 2000
BILLING_HORIZON = "2001-12-31"
N_PIZZAS = A.N_PIZZAS
LEDGER_MONTH = "2024-01"
YEARLY_RATE = 0.06
PERCENTILES = {"p50_seconds": 0.5, "p80_seconds": 0.8, "p95_seconds": 0.95}
BUCKETS = 16


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _money(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


# ====================================================================== restaurant

@query("spend_per_customer")
def q_spend(spark, d):
    out = AG.spend_by_key(A.sales(spark, d), A.menu(spark, d), "customer_id", "product_id", "price")
    return out.select("customer_id", "n_items", _money("total_spend").alias("total_spend"))


@query("visit_days_per_customer")
def q_visits(spark, d):
    return AG.visits(A.sales(spark, d), "customer_id", "order_date")


@query("first_item_per_customer")
def q_first_item(spark, d):
    first = SQ.first_last_by(A.sales(spark, d), "customer_id", "order_date", "product_id", "first")
    return first.join(A.menu(spark, d).select("product_id", "product_name"), "product_id", "left") \
                .select("customer_id", "order_date", "product_id", "product_name")


@query("first_day_items_all_ties")
def q_first_day_items(spark, d):
    return SQ.first_last_by(A.sales(spark, d), "customer_id", "order_date", "product_id", "first", ties="all")


@query("most_purchased_item")
def q_most_purchased(spark, d):
    top = AG.top_k_items(A.sales(spark, d), "product_id", k=1, count_name="n_bought")
    return top.join(A.menu(spark, d).select("product_id", "product_name"), "product_id", "left") \
              .select("product_id", "product_name", "n_bought")


@query("favourite_item_per_customer")
def q_favourite(spark, d):
    return AG.top_k_items(A.sales(spark, d), "product_id", k=1, by="customer_id", count_name="n_bought")


@query("favourite_items_all_ties")
def q_favourite_ties(spark, d):
    """Every item tied for a customer's highest purchase count."""
    return AG.top_k_items(A.sales(spark, d), "product_id", k=1, by="customer_id", count_name="n_bought", ties="all")


@query("first_item_after_joining")
def q_first_after(spark, d):
    return SQ.asof_event(A.sales(spark, d), A.members(spark, d), "customer_id", "order_date",
                         "join_date", "product_id", side="after")


@query("last_item_before_joining")
def q_last_before(spark, d):
    return SQ.asof_event(A.sales(spark, d), A.members(spark, d), "customer_id", "order_date",
                         "join_date", "product_id", side="before")


@query("spend_before_joining")
def q_spend_before(spark, d):
    out = SQ.totals_before_anchor(A.sales(spark, d), A.members(spark, d), "customer_id", "order_date", "join_date",
                                  "price", prices=A.menu(spark, d), item="product_id")
    return out.select("customer_id", "n_items", _money("amount_spent").alias("amount_spent"))


@query("loyalty_points")
def q_points(spark, d):
    out = LO.loyalty_points(A.sales(spark, d), A.menu(spark, d), "customer_id", "order_date", "product_id",
                            "product_name", "price", special_items=SPECIAL_ITEMS)
    return out.select("customer_id", _money("points").alias("points"))


@query("loyalty_points_first_week")
def q_points_week(spark, d):
    out = LO.loyalty_points(A.sales(spark, d), A.menu(spark, d), "customer_id", "order_date", "product_id",
                            "product_name", "price", special_items=SPECIAL_ITEMS,
                            members=A.members(spark, d), window_days=7, until=POINTS_UNTIL)
    return out.select("customer_id", _money("points").alias("points"))


@query("loyalty_points_eight_day_window")
def q_points_literal(spark, d):
    """Literal variant of the first-week bonus: ``order_date <= join_date + 7`` (eight
    days including the join day) and no cut-off date."""
    out = LO.loyalty_points(A.sales(spark, d), A.menu(spark, d), "customer_id", "order_date", "product_id",
                            "product_name", "price", special_items=SPECIAL_ITEMS,
                            members=A.members(spark, d), window_days=8)
    return out.select("customer_id", _money("points").alias("points"))


@query("loyalty_points_flat_bonus")
def q_points_flat(spark, d):
    """Literal variant of the special item's bonus: flat points for each special item a
    member has bought, instead of a multiplier, from the day of joining."""
    out = LO.flat_bonus_points(A.sales(spark, d), A.menu(spark, d), A.members(spark, d), "customer_id", "order_date", "product_id",
                               "product_name", "price", special_items=SPECIAL_ITEMS)
    return out.select("customer_id", _money("points").alias("points"))


# ====================================================================== delivery

def _lines(spark, d, line_ids: bool = False):
    """Clean order lines. Line ids only when a query addresses single lines."""
    raw = A.customer_orders_raw(spark, d, "line_id" if line_ids else None)
    return CL.clean_customer_orders(raw, line_id=None)


def _deliveries(spark, d):
    return CL.clean_runner_orders(A.runner_orders_raw(spark, d))


def _delivered(spark, d):
    return _deliveries(spark, d).filter(F.col("cancellation").isNull())


def _delivered_lines(spark, d, line_ids: bool = False):
    return _lines(spark, d, line_ids).join(_delivered(spark, d).select("order_id"), "order_id", "left_semi")


def _pizza_price():
    return F.when(F.col("pizza_id") % 2 == 1, F.lit(12)).otherwise(F.lit(10))


@query("order_counts")
def q_order_counts(spark, d):
    return A.customer_orders_raw(spark, d).agg(F.count(F.lit(1)).alias("n_lines"),
                                               F.countDistinct("order_id").alias("n_orders"))


@query("delivered_orders_per_runner")
def q_delivered_per_runner(spark, d):
    return _delivered(spark, d).groupBy("runner_id").agg(F.countDistinct("order_id").alias("n_delivered"))


@query("delivered_items_per_pizza")
def q_items_per_pizza(spark, d):
    counts = _delivered_lines(spark, d).groupBy("pizza_id").agg(F.count(F.lit(1)).alias("n_delivered"))
    return counts.join(A.pizza_names(spark, d), "pizza_id").select("pizza_name", "n_delivered")


@query("pizzas_per_customer_pivot")
def q_pizza_pivot(spark, d):
    return AG.pivot_counts(_lines(spark, d), "customer_id", "pizza_id", list(range(1, N_PIZZAS + 1)), "n_pizza_")


@query("largest_delivered_order")
def q_largest_order(spark, d):
    return AG.top_k_items(_delivered_lines(spark, d), "order_id", k=1, count_name="n_items")


@query("change_flags_per_customer")
def q_change_flags(spark, d):
    return AG.change_flags(_delivered_lines(spark, d), "customer_id", ["exclusions", "extras"])


@query("change_counts_full_join")
def q_change_full_join(spark, d):
    """The same counts as two separate aggregates merged by a full outer join on
    the customer (each side may miss customers the other has)."""
    changed = (list_size("exclusions") > 0) | (list_size("extras") > 0)
    # one pass over the lines; its two counts per customer are kept as a table and read twice
    per = _delivered_lines(spark, d).groupBy("customer_id", changed.alias("changed")).agg(F.count(F.lit(1)).alias("n"))
    per = stage_table(per, "changed-lines")
    a = per.filter(F.col("changed")).select("customer_id", F.col("n").alias("n_changed"))
    b = per.filter(~F.col("changed")).select("customer_id", F.col("n").alias("n_unchanged"))
    return a.join(b, "customer_id", "full").select(
        "customer_id", F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
        F.coalesce("n_unchanged", F.lit(0)).alias("n_unchanged"))


@query("volume_by_hour")
def q_by_hour(spark, d):
    return AG.time_bucket_counts(_lines(spark, d), "order_time", "hour", name="hour_of_day", count_name="n_items")


@query("volume_by_weekday")
def q_by_weekday(spark, d):
    return AG.time_bucket_counts(_lines(spark, d), "order_time", "weekday", name="iso_weekday", count_name="n_items")


@query("clean_runner_orders")
def q_clean_runner(spark, d):
    return _deliveries(spark, d)


@query("clean_customer_orders")
def q_clean_orders(spark, d):
    return _lines(spark, d, True).select("order_id", "customer_id", "pizza_id",
                                   F.array_join("exclusions", ",").alias("exclusions"),
                                   F.array_join("extras", ",").alias("extras"),
                                   "order_time", "line_id")


@query("changed_toppings_per_order")
def q_changed_toppings(spark, d):
    """Toppings left out of or added to an order, each once (UNION)."""
    lines = _lines(spark, d)
    out, extra = (CL.explode_list(lines, c, keep=["order_id"], out="topping_id", parsed=True)
                  .select("order_id", "topping_id") for c in ("exclusions", "extras"))
    return out.union(extra).distinct()


@query("recipe_bridge")
def q_bridge(spark, d):
    return CL.bridge_table(A.pizza_recipes(spark, d))


@query("runner_signups_per_week")
def q_signups(spark, d):
    return AG.time_bucket_counts(A.runners(spark, d), "registration_date", "week_block",
                                 name="week_of_year", count_name="n_runners")


def _order_times(spark, d):
    return A.order_summaries(spark, d)


@query("pickup_minutes_per_runner")
def q_pickup_minutes(spark, d):
    j = _order_times(spark, d).join(_delivered(spark, d), "order_id")
    return AG.duration_stats(j, "order_time", "pickup_time", "minute", by="runner_id", prefix="pickup_minutes_")


@query("prep_minutes_by_items")
def q_prep_by_items(spark, d):
    j = _order_times(spark, d).join(_delivered(spark, d), "order_id") \
        .withColumn("prep", minutes_between("order_time", "pickup_time"))
    return j.groupBy("n_items").agg(F.count(F.lit(1)).alias("n_orders"), F.avg("prep").alias("avg_prep_minutes"))


@query("avg_distance_per_customer")
def q_avg_distance(spark, d):
    per_order = _order_times(spark, d).select("order_id", "customer_id")
    j = per_order.join(_delivered(spark, d).select("order_id", "distance"), "order_id")
    # decimal average (exact, rounded half-up), not a double: no binary rounding surprises
    return j.groupBy("customer_id").agg(F.avg("distance").cast("decimal(12,4)").alias("avg_distance_km"))


@query("delivery_duration_range")
def q_duration_range(spark, d):
    t = _delivered(spark, d)
    return t.agg(F.min("duration").alias("min_duration"), F.max("duration").alias("max_duration"),
                 (F.max("duration") - F.min("duration")).alias("duration_range"))


@query("avg_speed_per_runner")
def q_speed(spark, d):
    out = AG.rate_stats(_delivered(spark, d), "distance", "duration", by="runner_id", scale=60.0, name="avg_speed_kmh")
    return out.select("runner_id", F.round("avg_speed_kmh", 2).alias("avg_speed_kmh"))


@query("success_rate_per_runner")
def q_success(spark, d):
    return AG.share_of_total(_deliveries(spark, d), F.col("cancellation").isNull(), by="runner_id",
                             n_name="n_delivered", total_name="n_orders", pct_name="pct_delivered")


@query("recipe_ingredients")
def q_recipe_ingredients(spark, d):
    names = A.pizza_names(spark, d)
    dec = CL.decode_list(A.pizza_recipes(spark, d, names), "pizza_id", "toppings", A.pizza_toppings(spark),
                         out="ingredients", parsed=False)
    return dec.join(names, "pizza_id").select("pizza_name", "ingredients")


def _top_list_entry(spark, d, col):
    ex = CL.explode_list(_lines(spark, d), col, out="topping_id", parsed=True)
    top = AG.top_k_items(ex, "topping_id", k=1, count_name="n")
    return top.join(A.pizza_toppings(spark), "topping_id").select("topping_id", "topping_name", "n")


@query("most_common_extra")
def q_top_extra(spark, d):
    return _top_list_entry(spark, d, "extras")


@query("most_common_exclusion")
def q_top_exclusion(spark, d):
    return _top_list_entry(spark, d, "exclusions")


@query("order_line_labels")
def q_line_labels(spark, d):
    m = CL.dictionary_map(A.TOPPINGS)
    j = _lines(spark, d, True).join(A.pizza_names(spark, d), "pizza_id")
    label = CL.line_label("pizza_name", [("Exclude", CL.decode_array("exclusions", m)),
                                         ("Extra", CL.decode_array("extras", m))])
    return j.select("order_id", "line_id", label.alias("label"))


@query("ingredient_bill")
def q_bill(spark, d):
    names = A.pizza_names(spark, d)
    return RE.ingredient_bill(_lines(spark, d, True), A.pizza_recipes(spark, d, names), names, A.TOPPINGS)


@query("ingredient_usage_delivered")
def q_usage(spark, d):
    return RE.ingredient_usage(_delivered_lines(spark, d), A.pizza_recipes(spark, d), A.pizza_toppings(spark))


@query("ingredient_usage_set_ops")
def q_usage_setops(spark, d):
    """Same totals as ``ingredient_usage_delivered`` with set operators over
    exploded rows: (base EXCEPT exclusions) UNION ALL extras, then one count."""
    return RE.usage_by_set_ops(_delivered_lines(spark, d), A.pizza_recipes(spark, d), A.pizza_toppings(spark))


@query("ingredient_usage_bits")
def q_usage_bits(spark, d):
    """The same totals by bit sets and counted columns."""
    return RE.usage_by_bits(_delivered_lines(spark, d), A.pizza_recipes(spark, d), A.TOPPINGS)


@query("revenue_by_delivery_status")
def q_revenue(spark, d):
    flag = _deliveries(spark, d).select("order_id", F.col("cancellation").isNull().alias("delivered"))
    lines = _lines(spark, d).join(flag, "order_id")
    return AG.revenue_by(lines, "delivered", _pizza_price(), "extras", 1)


@query("net_revenue_after_distance_cost")
def q_net_revenue(spark, d):
    return RE.net_of_distance_cost(_lines(spark, d), _deliveries(spark, d), _pizza_price(), cost_per_km=0.30)


@query("delivery_report")
def q_delivery_report(spark, d):
    rated = _deliveries(spark, d).withColumn("rating", (F.col("order_id") % 5 + 1).cast("int"))
    return RE.delivery_report(None, rated, per_order=A.order_summaries(spark, d))


# ====================================================================== subscriptions

def _subs(spark, d):
    return A.subscriptions(spark, d)


@query("customer_count")
def q_customers(spark, d):
    return _subs(spark, d).agg(F.countDistinct("customer_id").alias("n_customers"))


@query("trial_starts_per_month")
def q_trials_month(spark, d):
    t = _subs(spark, d).filter(F.col("plan_id") == 0)
    return AG.time_bucket_counts(t, "start_date", "month", name="month", count_name="n_trials")


@query("trial_starts_in_order")
def q_trials_ordered(spark, d):
    return q_trials_month(spark, d).orderBy("month")


@query("plan_starts_after_year")
def q_plan_starts(spark, d):
    # a date range rather than year(...) > Y: the range reaches the Parquet scan
    t = _subs(spark, d).filter(F.col("start_date") >= F.lit(f"{REPORT_YEAR + 1}-01-01").cast("date")) \
        .join(A.plans(spark), "plan_id")
    return AG.time_bucket_counts(t, "start_date", "month", by="plan_name", name="month", count_name="n_events")


@query("churn_share")
def q_churn(spark, d):
    return AG.share_of_total(_subs(spark, d), F.col("plan_id") == 4, distinct="customer_id",
                             n_name="n_churned", total_name="n_customers", pct_name="pct_churned")


@query("churn_share_text")
def q_churn_text(spark, d):
    """The churn share as a label."""
    return q_churn(spark, d).select("n_churned", "n_customers",
                                    percent_text("n_churned", "n_customers").alias("churned"))


@query("churn_share_of_rows")
def q_churn_rows(spark, d):
    """Literal variant of the churn share: churn rows over all subscription rows
    (the source's denominator), instead of churned customers over customers."""
    return AG.share_of_total(_subs(spark, d), F.col("plan_id") == 4, n_name="n_churn_rows",
                             total_name="n_rows", pct_name="pct_of_rows")


@query("churned_without_paid_plan")
def q_churn_only(spark, d):
    return SQ.reached_only_share(_subs(spark, d), "customer_id", "plan_id", 4, [1, 2, 3],
                                 n_name="n_churned_straight", base_name="n_churners", pct_name="pct_of_churners")


@query("churned_without_paid_plan_joins")
def q_churn_only_joins(spark, d):
    ents = SQ.reached_only_joins(_subs(spark, d), "customer_id", "plan_id", 4, [1, 2, 3])
    return ents.agg(F.count(F.lit(1)).alias("n_churned_straight"))


@query("churn_right_after_trial")
def q_churn_after_trial(spark, d):
    t = SQ.plan_transitions(_subs(spark, d), "customer_id", "start_date", "plan_id", "sub_seq", nxt=False,
                            by_range=True)
    hit = (F.col("prev_plan_id") == 0) & (F.col("plan_id") == 4)
    return t.agg(F.count_if(hit).alias("n_churned_after_trial"),
                 F.countDistinct("customer_id").alias("n_customers")) \
            .withColumn("pct_of_customers", F.round(F.col("n_churned_after_trial") * 100.0 / F.col("n_customers"), 1))


@query("plan_after_trial")
def q_plan_after_trial(spark, d):
    t = SQ.plan_transitions(_subs(spark, d), "customer_id", "start_date", "plan_id", "sub_seq", prev=False,
                            by_range=True)
    trial = t.filter((F.col("plan_id") == 0) & F.col("next_plan_id").isNotNull())
    return AG.share_of_total(trial, F.lit(True), by="next_plan_id", within="all",
                             n_name="n", total_name="n_trials_with_next", pct_name="pct")


@query("paid_changes_share")
def q_paid_changes(spark, d):
    """Literal variant of the plans after the trial: all paid changes, not each customer's
    first one, as a share of all changes but churn."""
    t = _subs(spark, d).agg(F.count_if(F.col("plan_id").isin(1, 2, 3)).alias("n_paid"), F.count_if(F.col("plan_id") != 4).alias("n_changes"))
    return t.select("n_paid", "n_changes", percent_text("n_paid", "n_changes", 2).alias("share"))


@query("plan_mix_at_date")
def q_plan_mix(spark, d):
    cur = SQ.state_as_of(_subs(spark, d), "customer_id", "start_date", "plan_id", PLAN_MIX_DATE, tiebreak="sub_seq")
    mix = AG.share_of_total(cur, F.lit(True), by="plan_id", within="all",
                            n_name="n_customers", total_name="n_active", pct_name="pct")
    return mix.join(A.plans(spark), "plan_id").select("plan_id", "plan_name", "n_customers", "n_active", "pct")


@query("plan_mix_before_date_active")
def q_plan_mix_literal(spark, d):
    """Literal variant of the plan mix: states strictly before the date, churned
    customers left out of both counts."""
    cur = SQ.state_as_of(_subs(spark, d), "customer_id", "start_date", "plan_id", PLAN_MIX_DATE,
                         inclusive=False, tiebreak="sub_seq").filter(F.col("plan_id") != 4)
    mix = AG.share_of_total(cur, F.lit(True), by="plan_id", within="all",
                            n_name="n_customers", total_name="n_active", pct_name="pct")
    return mix.join(A.plans(spark), "plan_id").select("plan_id", "plan_name", "n_customers", "n_active", "pct")


@query("annual_upgrades_in_year")
def q_annual_year(spark, d):
    in_year = F.col("start_date").between(F.lit(f"{REPORT_YEAR}-01-01").cast("date"),
                                          F.lit(f"{REPORT_YEAR}-12-31").cast("date"))
    t = _subs(spark, d).filter((F.col("plan_id") == 3) & in_year)
    return t.agg(F.countDistinct("customer_id").alias("n_customers"))


@query("avg_days_to_annual")
def q_days_to_annual(spark, d):
    t = SQ.time_between_states(_subs(spark, d), "customer_id", "start_date", "plan_id", 0, 3)
    return t.agg(F.avg("days").alias("avg_days"), F.count(F.lit(1)).alias("n_customers"))


@query("days_to_annual_self_join")
def q_days_self_join(spark, d):
    """The same average with the table joined to itself in two roles, each reduced to
    one row per customer before it."""
    role = lambda plan, name: (_subs(spark, d).filter(F.col("plan_id") == plan)
                               .groupBy("customer_id").agg(F.min("start_date").alias(name)))
    j = role(0, "trial").join(role(3, "annual"), "customer_id").filter(F.col("annual") >= F.col("trial"))
    return j.agg(F.avg(F.datediff("annual", "trial")).alias("avg_days"), F.count(F.lit(1)).alias("n_customers"))


@query("days_to_annual_buckets")
def q_days_buckets(spark, d):
    t = SQ.time_between_states(_subs(spark, d), "customer_id", "start_date", "plan_id", 0, 3)
    b = AG.bucketize(t, "days", 30, index_name="bucket", label_name="days_range")
    return b.groupBy("bucket", "days_range").agg(F.count(F.lit(1)).alias("n_customers"))


@query("days_to_annual_buckets_capped")
def q_days_buckets_capped(spark, d):
    """Literal variant of the 30-day breakdown: everything past 180 days in one
    '180+ days' bucket."""
    t = SQ.time_between_states(_subs(spark, d), "customer_id", "start_date", "plan_id", 0, 3)
    b = AG.bucketize(t, "days", 30, cap=180, index_name="bucket", label_name="days_range")
    return b.groupBy("bucket", "days_range").agg(F.count(F.lit(1)).alias("n_customers"))


@query("downgrades_in_year")
def q_downgrades(spark, d):
    return SQ.count_transitions(_subs(spark, d), "customer_id", "start_date", "plan_id", 2, 1, "sub_seq",
                                year=REPORT_YEAR, name="n_downgrades", by_range=True)


@query("monthly_renewal_dates")
def q_renewals(spark, d):
    """O12 on its own: every monthly renewal date of every paid change (sticky month
    ends), from its start until the next change or the horizon."""
    t = SQ.plan_transitions(_subs(spark, d), "customer_id", "start_date", "plan_id", "sub_seq", prev=False,
                            by_range=True)
    paid = t.filter(F.col("plan_id").isin(1, 2, 3)).withColumn(
        "end_date", F.coalesce("next_start_date", F.lit(BILLING_HORIZON).cast("date")))
    out = BI.recurring_dates(paid, "start_date", "end_date", 1, out="renewal_date")
    return out.select("customer_id", "plan_id", "renewal_date")


@query("payment_ledger")
def q_ledger(spark, d):
    return BI.billing_ledger(_subs(spark, d), A.plans(spark), BILLING_HORIZON, by_range=True)


# ====================================================================== bank

@query("unique_nodes")
def q_unique_nodes(spark, d):
    return A.customer_nodes(spark, d, ends=False).agg(F.countDistinct("node_id").alias("n_nodes"))


@query("nodes_and_customers_per_region")
def q_nodes_region(spark, d):
    return AG.distinct_per_group(A.regions(spark, d), A.customer_nodes(spark, d, ends=False), "region_id", "region_name",
                                 {"n_nodes": "node_id", "n_customers": "customer_id"})


@query("reallocation_days")
def q_realloc(spark, d):
    out = LE.interval_stats(A.customer_nodes(spark, d), "start_date", "end_date")
    return out.select("avg_days", *[F.round(c, 4).alias(c) for c in ("p50_days", "p80_days", "p95_days")])


@query("reallocation_days_with_open")
def q_realloc_open(spark, d):
    """Literal variant: allocations that last until 9999 count with their full length."""
    t = A.customer_nodes(spark, d).select("region_id", F.datediff("end_date", "start_date").alias("days"))
    mean = t.agg(F.avg("days").alias("avg_days"), F.count("days").alias("n_allocations"), F.count_if(F.col("days") > 2_000_000).alias("n_open"))
    return mean


@query("reallocation_days_by_region")
def q_realloc_region(spark, d):
    regions = A.regions(spark, d)
    j = A.customer_nodes(spark, d).join(regions, "region_id")
    out = LE.interval_stats(j, "start_date", "end_date", by="region_name", groups=regions)
    return out.select("region_name", "avg_days",
                      *[F.round(c, 4).alias(c) for c in ("p50_days", "p80_days", "p95_days")])


def _txns(spark, d):
    return A.customer_transactions(spark, d)


@query("transaction_type_summary")
def q_txn_types(spark, d):
    return _txns(spark, d).groupBy("txn_type").agg(
        F.countDistinct("customer_id").alias("n_customers"), F.count(F.lit(1)).alias("n_txns"),
        _money(F.sum("txn_amount")).alias("total_amount"))


@query("avg_deposits_per_customer")
def q_avg_deposits(spark, d):
    out = AG.per_entity_average(_txns(spark, d), "customer_id", F.col("txn_type") == "deposit", "txn_amount",
                                "avg_deposit_count", "avg_deposit_amount")
    return out.select("avg_deposit_count", F.round(F.col("avg_deposit_amount").cast("double"), 2).alias("avg_deposit_amount"))


@query("active_customers_per_month")
def q_active(spark, d):
    return AG.activity_rule(_txns(spark, d), "customer_id", month_key("txn_date"), "txn_type",
                            {"deposit": (["deposit"], 2), "purchase": (["purchase"], 1),
                             "withdrawal": (["withdrawal"], 1)})


@query("active_customers_two_counts")
def q_active_two(spark, d):
    """Literal variant of the activity rule: per month the customers with a deposit and,
    apart from them, those with a purchase or withdrawal, in months that have both."""
    kind = F.col("txn_type")
    per = _txns(spark, d).groupBy(month_key("txn_date").alias("month"), "customer_id").agg(
        F.bool_or(kind == "deposit").alias("pays_in"), F.bool_or(kind.isin("purchase", "withdrawal")).alias("spends"))
    both = per.groupBy("month").agg(F.count_if("pays_in").alias("n_depositors"), F.count_if("spends").alias("n_spenders"))
    return both.filter((F.col("n_depositors") > 0) & (F.col("n_spenders") > 0))


def _monthly_balances(spark, d):
    net = LE.signed_ledger(_txns(spark, d), "customer_id", "txn_date", "txn_type", "txn_amount", "month")
    return LE.running_balance(net, "customer_id", "month", "net", "balance")


@query("monthly_closing_balance")
def q_monthly_balance(spark, d):
    return _monthly_balances(spark, d)


@query("monthly_closing_balance_filled")
def q_monthly_balance_filled(spark, d):
    """Closing balance for every month from a customer's first month to the last
    month of the data, months without transactions carrying the previous balance."""
    return LE.densify_months(_monthly_balances(spark, d), "customer_id", "month", "balance")


@query("balance_growth_over_5pct")
def q_growth(spark, d):
    """Over consecutive months, silent ones included, out of the customers that have a
    month before."""
    filled = LE.densify_months(_monthly_balances(spark, d), "customer_id", "month", "balance")
    return LE.growth_over_threshold(filled, "customer_id", "month", "balance", 0.05, base="previous")


@query("balance_growth_active_months")
def q_growth_active(spark, d):
    """Literal variant: over months with transactions only, out of all customers active
    in the month."""
    return LE.growth_over_threshold(_monthly_balances(spark, d), "customer_id", "month", "balance", 0.05)


def _txn_balances(spark, d):
    return LE.transaction_balances(_txns(spark, d), "customer_id", "txn_date", "txn_type", "txn_amount",
                                   by_range=True)


@query("running_balance_per_transaction")
def q_txn_balance(spark, d):
    return _txn_balances(spark, d).select("customer_id", "txn_date", "txn_type", "txn_amount", "impact", "balance")


@query("balance_range_per_customer")
def q_balance_range(spark, d):
    return LE.balance_range(_txn_balances(spark, d), "customer_id")


@query("months_with_more_depositors_than_buyers")
def q_depositor_months(spark, d):
    """A conditional distinct count in the group filter (HAVING), as one row per customer
    and month first, then two plain counts."""
    kind = F.col("txn_type")
    per = _txns(spark, d).groupBy(month_key("txn_date").alias("month"), "customer_id").agg(
        F.bool_or(kind == "deposit").alias("deposits"), F.bool_or(kind == "purchase").alias("buys"))
    return per.groupBy("month").agg(F.count_if("deposits").alias("n_depositors"), F.count_if("buys").alias("n_buyers")) \
              .filter(F.col("n_depositors") > F.col("n_buyers"))


@query("whole_deposits_per_customer")
def q_whole_deposits(spark, d):
    """Integer average: the quotient is cut, not rounded."""
    t = _txns(spark, d).agg(F.count_if(F.col("txn_type") == "deposit").alias("n_deposits"),
                            F.countDistinct("customer_id").alias("n_customers"))
    return t.withColumn("deposits_per_customer", F.expr("n_deposits div nullif(n_customers, 0)"))


@query("customer_history")
def q_history(spark, d):
    """Plan changes and account movements in one list; what a branch lacks is NULL."""
    schema = "customer_id bigint, event_date date, plan_id int, txn_type string, amount decimal(12,2)"
    changes = _subs(spark, d).withColumnRenamed("start_date", "event_date")
    moves = _txns(spark, d).withColumnsRenamed({"txn_date": "event_date", "txn_amount": "amount"})
    return conform(changes, schema).unionAll(conform(moves, schema))


def _daily(spark, d):
    """The daily ledger, built once for all queries over it: partitioned by month, sorted
    within the files. History runs to the end of the month of the latest transaction."""
    def build(place):
        daily = LE.daily_balances(A.event_transactions(spark, d), "customer_id", "txn_date", "txn_type", "txn_amount")
        replace_partitions(daily.withColumn("month", month_key("bal_date")), place, ["month"], ["customer_id", "bal_date"])
        return load_table(spark, place, "customer_id bigint, bal_date date, balance decimal(18,2), month string")

    return shared(spark, "daily-ledger", [table_path(d, "events")], build)


@query("monthly_closing_balance_sql")
def q_monthly_balance_sql(spark, d):
    """The same ledger through the SQL API: the adapter passed as a relation and
    a named window (``WINDOW w AS (...)``); Catalyst plans it like the DataFrame
    form."""
    return spark.sql("""
        WITH net AS (
          SELECT customer_id, date_format(txn_date, 'yyyy-MM') AS month,
                 CAST(coalesce(SUM(txn_amount) FILTER (WHERE txn_type = 'deposit'), 0)
                      - coalesce(SUM(txn_amount) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')), 0) AS DECIMAL(18,2)) AS net
          FROM {txns} GROUP BY customer_id, date_format(txn_date, 'yyyy-MM'))
        SELECT customer_id, month, net, CAST(SUM(net) OVER w AS DECIMAL(18,2)) AS balance
        FROM net
        WINDOW w AS (PARTITION BY customer_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", txns=_txns(spark, d))


@query("daily_balances")
def q_daily(spark, d):
    return _daily(spark, d).drop("month")


@query("closing_balances_in_month")
def q_closing_in_month(spark, d):
    """What each customer held when one month closed: one partition of the ledger is read."""
    return _daily(spark, d).where((F.col("month") == LEDGER_MONTH) & (F.col("bal_date") == F.last_day("bal_date"))) \
                           .select("customer_id", "balance")


@query("allocation_month_end")
def q_alloc_month(spark, d):
    return LE.allocation_period_end(_daily(spark, d))


@query("allocation_previous_month_end")
def q_alloc_previous(spark, d):
    """The month's provision: closing balances of the month before."""
    return LE.allocation_period_end(_daily(spark, d), months_later=1)


@query("allocation_trailing_30_monthly")
def q_alloc_trailing_monthly(spark, d):
    return LE.allocation_trailing(_daily(spark, d), rows=30, monthly=True, by_range=True)


@query("allocation_realtime_monthly")
def q_alloc_daily_monthly(spark, d):
    return LE.allocation_daily(_daily(spark, d), monthly=True)


@query("allocation_trailing_30")
def q_alloc_trailing(spark, d):
    return LE.allocation_trailing(_daily(spark, d), rows=30, by_range=True)


@query("allocation_realtime")
def q_alloc_daily(spark, d):
    return LE.allocation_daily(_daily(spark, d))


@query("interest_accrual")
def q_interest(spark, d):
    return LE.accrue(_daily(spark, d).drop("month"), "balance", 0.06, 365)


@query("interest_compounded")
def q_compounded(spark, d):
    """The balance after each day with transactions when interest is paid in daily and
    earns interest itself."""
    net = LE.signed_ledger(_txns(spark, d), "customer_id", "txn_date", "txn_type", "txn_amount", "day", "txn_date")
    out = OR.compound(net, "customer_id", "txn_date", "net", YEARLY_RATE, 365)
    return out.select("customer_id", "txn_date", F.round("balance", 2).alias("balance"))


# ====================================================================== any order, any size

@query("lines_shipped_per_plan")
def q_shipped_per_plan(spark, d):
    """How much each customer was shipped under each plan: the plan in force on the day of
    shipping, of all the changes the customer made."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_shipdate", "l_quantity")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    # a customer's lines of one day are one fact
    shipped = (li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("customer_id"), F.col("l_shipdate").cast("date").alias("ship_date"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("quantity")))
    shipped = stage_table(shipped, "shipped-days")  # read for heavy customers as well
    out = OR.in_force(shipped, _subs(spark, d), "customer_id", "ship_date", "start_date", "plan_id", tiebreak="sub_seq")
    return out.groupBy("customer_id", "plan_id").agg(F.sum("n").alias("n_lines"), _money(F.sum("quantity")).alias("quantity"))


@query("event_gap_percentiles")
def q_gap_percentiles(spark, d):
    """Seconds between an event and the same user's one before, by type of event."""
    e = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    t = OR.neighbours(e, "user_id", ["ts", "event_id"], "ts", nxt=False)
    gaps = t.select("event_type", (F.timestamp_diff("MICROSECOND", F.col("prev_ts"), F.col("ts")) / F.lit(1e6)).alias("seconds"))
    out = quantiles(gaps, "event_type", "seconds", PERCENTILES)
    return out.select("event_type", *[F.round(c, 4).alias(c) for c in PERCENTILES])


@query("numbered_lines")
def q_numbered_lines(spark, d):
    """One dense number over all lines of all orders."""
    t = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return number_rows(t, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("customers_kept_by_sketch")
def q_customers_kept(spark, d):
    """Active customers of each month and those active in the month before as well, counted
    exactly, and whether the estimates from daily sketches rolled up to months are in bounds."""
    t = _txns(spark, d).select(month_key("txn_date").alias("month"), "txn_date", "customer_id")
    hll, theta = (SK.roll_up(SK.distinct_sketches(t, ["month", "txn_date"], "customer_id", kind=k), "month", kind=k) for k in ("hll", "theta"))
    before = theta.select(F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyy-MM").alias("month"), F.col("sketch").alias("earlier"))
    estimates = (hll.select("month", SK.estimate("sketch").alias("about")).join(theta.select("month", "sketch"), "month").join(before, "month", "left")
                 .select("month", "about", F.coalesce(SK.in_both("sketch", "earlier"), F.lit(0)).alias("about_kept"), SK.estimate(F.theta_union("sketch", "earlier"), "theta").alias("about_either")))
    months = t.select("month", "customer_id").distinct()
    last = months.select(F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyy-MM").alias("month"), "customer_id", F.lit(1).alias("kept"))
    exact = months.join(last, ["month", "customer_id"], "left").groupBy("month").agg(F.count(F.lit(1)).alias("n_customers"), F.count("kept").alias("n_kept"))
    off, off_kept = F.abs(F.col("about") - F.col("n_customers")), F.abs(F.col("about_kept") - F.col("n_kept"))
    return exact.join(estimates, "month").select(
        "month", "n_customers", "n_kept", (off <= SK.bound(F.col("n_customers"))).alias("estimate_in_bounds"),
        (off_kept <= SK.bound(F.coalesce("about_either", "n_customers"), kind="theta")).alias("kept_in_bounds"))


def _bucketed(spark, d, name, key, *columns):
    """A fact table kept in buckets of its join key, in a database of its own."""
    def build(place):
        ensure_database(spark, "casebook")
        path = table_path(d, name)
        return save_bucketed(read_table(spark, d, name, *columns), f"casebook.{name}_{version(spark, [path])}", place, key, BUCKETS)

    return shared(spark, f"bucketed-{name}", [table_path(d, name)], build)


@query("quantity_per_customer_bucketed")
def q_bucketed(spark, d):
    """Lines join orders without an exchange: both are kept bucketed by the order."""
    li = _bucketed(spark, d, "lineitem", "l_orderkey", "l_orderkey", "l_quantity")
    o = _bucketed(spark, d, "orders", "o_orderkey", "o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count(F.lit(1)).alias("n_lines"), _money(F.sum(F.col("l_quantity").cast("decimal(12,2)"))).alias("quantity"))


STRICT = {"pickup_time": "timestamp_ntz", "distance": "decimal(10,2)", "duration": "int"}


@query("quarantined_cells")
def q_quarantined(spark, d):
    """Delivery measurements that are no plain values: units left on, in the way of a typed load."""
    return split_typed(A.runner_orders_raw(spark, d), STRICT, "order_id")[1]


@query("conversion_account")
def q_account(spark, d):
    return account(A.runner_orders_raw(spark, d), STRICT)
