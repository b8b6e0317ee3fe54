"""Ingredient accounting, revenue and the delivery report.

Per-line ingredient lists are computed with array functions inside one projection
(base recipe minus exclusions plus extras), so building a bill needs no shuffle; only
the totals per ingredient (O17) aggregate, with a partial aggregate before the
exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.bits import bit_set, count_vector, without
from casebook.functions.dates import minutes_between
from casebook.functions.lists import list_size, split_list
from casebook.functions.safe import safe_div
from casebook.operators.cleaning import dictionary_map


def _empty_int_array() -> Column:
    return F.array().cast("array<int>")


def line_ingredients(lines: DataFrame, recipes: DataFrame, pizza: str = "pizza_id",
                     toppings: str = "toppings", exclusions: str = "exclusions",
                     extras: str = "extras", out: str = "ingredients") -> DataFrame:
    """Adds ``out`` = every ingredient used by the line, with repeats:
    distinct base recipe entries not excluded, then every extra (an extra that is
    also in the base therefore appears twice; excluding an item that is not in the
    base changes nothing; listing an exclusion twice removes it once).

    ``recipes`` carries the raw delimited ``toppings`` text per pizza; it has one row
    per pizza kind, and the join strategy is left to Spark (AQE broadcasts it when it
    is measured small). A line of a pizza without a recipe has no ingredients to list and
    is left out.
    """
    r = recipes.select(pizza, split_list(toppings).alias("_base"))
    j = lines.join(r, pizza)
    kept = F.array_except(F.coalesce(F.col("_base"), _empty_int_array()),
                          F.coalesce(F.col(exclusions), _empty_int_array()))
    return j.withColumn(out, F.concat(kept, F.coalesce(F.col(extras), _empty_int_array()))).drop("_base")


def ingredient_bill(lines: DataFrame, recipes: DataFrame, names: DataFrame,
                    dictionary: Mapping[int, str] | Sequence[tuple[int, str]],
                    keys: Sequence[str] = ("order_id", "line_id"), pizza: str = "pizza_id",
                    pizza_name: str = "pizza_name", out: str = "ingredient_list") -> DataFrame:
    """'Name: 2xBacon, Beef, Cheese' per line: ingredients ordered by name, a count
    prefix on those used more than once. Lines whose pizza has no recipe or no name are
    left out."""
    li = line_ingredients(lines, recipes, pizza)
    m = dictionary_map(dictionary)
    ing = F.col("ingredients")
    entries = F.transform(F.array_distinct(ing), lambda t: F.struct(
        F.try_element_at(m, t).alias("name"),
        F.size(F.filter(ing, lambda x: x == t)).alias("n")))
    labels = F.transform(F.array_sort(entries), lambda e: F.when(
        e["n"] > 1, F.concat(e["n"].cast("string"), F.lit("x"), e["name"])).otherwise(e["name"]))
    j = li.join(names.select(pizza, pizza_name), pizza)
    return j.select(*keys, F.concat(F.col(pizza_name), F.lit(": "), F.array_join(labels, ", ")).alias(out))


def ingredient_usage(lines: DataFrame, recipes: DataFrame, dictionary_df: DataFrame,
                     pizza: str = "pizza_id", item: str = "topping_id", name: str = "topping_name",
                     count_name: str = "n_used") -> DataFrame:
    """Total quantity of each ingredient over ``lines``: explode each line's
    ingredient list, then one aggregate per ingredient (partial aggregation first,
    so the few very frequent ingredients do not concentrate rows in one task)."""
    li = line_ingredients(lines, recipes, pizza)
    counts = li.select(F.explode("ingredients").alias(item)).groupBy(item).agg(F.count(F.lit(1)).alias(count_name))
    return counts.join(dictionary_df.select(item, name), item, "left")


def alike(lines: DataFrame, pizza: str = "pizza_id", exclusions: str = "exclusions", extras: str = "extras",
          name: str = "n_lines") -> DataFrame:
    """Lines of one pizza with the same changes as one row with their number: what is used
    is the same for all of them. There are few such rows however many lines there are."""
    return lines.groupBy(pizza, exclusions, extras).agg(F.count(F.lit(1)).alias(name))


def usage_by_set_ops(lines: DataFrame, recipes: DataFrame, dictionary_df: DataFrame, pizza: str = "pizza_id",
                     item: str = "topping_id", name: str = "topping_name", count_name: str = "n_used") -> DataFrame:
    """The totals of :func:`ingredient_usage` with set operators over exploded rows: (base
    EXCEPT exclusions) UNION ALL extras, of lines alike at a time, then one weighted sum."""
    kinds = alike(lines, pizza)
    kind = F.struct(pizza, "exclusions", "extras").alias("kind")
    base = kinds.join(recipes.select(pizza, split_list("toppings").alias("_base")), pizza)
    base = base.select(kind, "n_lines", F.explode("_base").alias(item))
    left_out, more = (kinds.select(kind, "n_lines", F.explode(c).alias(item)) for c in ("exclusions", "extras"))
    used = base.subtract(left_out).unionAll(more)
    counts = used.groupBy(item).agg(F.sum("n_lines").alias(count_name))
    return counts.join(dictionary_df.select(item, name), item, "left")


def usage_by_bits(lines: DataFrame, recipes: DataFrame, dictionary: Sequence[tuple[int, str]], pizza: str = "pizza_id",
                  item: str = "topping_id", name: str = "topping_name", count_name: str = "n_used") -> DataFrame:
    """The same totals without a row for each ingredient: recipes and exclusions are bit
    sets, EXCEPT is a bit operation, and one aggregate sums a column for each member of
    the (small, fixed) dictionary. Members nobody uses are left out."""
    base = recipes.select(pizza, bit_set(split_list("toppings")).alias("_base"))
    kept = without(F.coalesce("_base", F.lit(0).cast("long")), bit_set("exclusions"))
    j = lines.join(base, pizza)
    sums = j.agg(*[F.sum(c).alias(f"_{m}") for m, c in count_vector(kept, "extras", [m for m, _ in dictionary]).items()])
    rows = F.array(*[F.struct(F.lit(m).alias(item), F.col(f"_{m}").alias(count_name), F.lit(n).alias(name)) for m, n in dictionary])
    return sums.select(F.explode(rows).alias("r")).select("r.*").where(F.col(count_name) > 0)


# ---------------------------------------------------------------- O22

def revenue(lines: DataFrame, price: Column, extras: str = "extras",
            surcharge_per_extra: float | int = 0, name: str = "revenue") -> DataFrame:
    """One row: sum over lines of ``price`` + ``surcharge_per_extra`` per listed
    extra (list size, so two-digit ids count once)."""
    per_line = price + F.lit(surcharge_per_extra) * list_size(extras)
    return lines.agg(F.sum(per_line).alias(name))


def net_of_distance_cost(lines: DataFrame, deliveries: DataFrame, price: Column, order: str = "order_id",
                         distance: str = "distance", cost_per_km: str = "0.30",
                         name: str = "net_revenue") -> DataFrame:
    """Delivered revenue minus a per-km cost. Distance is counted once per order
    (the cost is aggregated on the delivery table, before it meets the lines, so a
    multi-line order does not repeat it). Money stays decimal: the rate is given as text."""
    rate = F.lit(cost_per_km).cast("decimal(6,2)")
    delivered = deliveries.filter(F.col("cancellation").isNull()).select(order, distance)
    rev = lines.join(delivered.select(order), order, "left_semi").agg(F.sum(price).alias("revenue"))
    km = delivered.agg(F.sum(distance)).scalar()  # uncorrelated scalar subquery
    return rev.select("revenue",
                      (km.cast("decimal(18,2)") * rate).cast("decimal(18,2)").alias("delivery_cost"),
                      (F.col("revenue") - km.cast("decimal(18,2)") * rate).cast("decimal(18,2)").alias(name))


# ---------------------------------------------------------------- O23

def delivery_report(lines: DataFrame | None, deliveries: DataFrame, ratings: DataFrame | None = None,
                    order: str = "order_id", per_order: DataFrame | None = None) -> DataFrame:
    """One row per delivered order: customer, runner, rating, order and pickup
    times, minutes to pickup (minute boundaries), duration, average speed (km/h)
    and item count. Lines are reduced to one row per order before the joins; give
    ``per_order`` (customer_id, order_time, n_items) where that has been done already.
    Without ``ratings`` the deliveries carry their ``rating``."""
    if per_order is None:
        per_order = lines.groupBy(order).agg(F.min("customer_id").alias("customer_id"),
                                             F.min("order_time").alias("order_time"),
                                             F.count(F.lit(1)).alias("n_items"))
    j = per_order.join(deliveries.filter(F.col("cancellation").isNull()), order)
    if ratings is not None:
        j = j.join(ratings, order, "left")
    return j.select(
        "customer_id", order, "runner_id", "rating", "order_time", "pickup_time",
        minutes_between("order_time", "pickup_time").alias("minutes_to_pickup"),
        F.col("duration").alias("delivery_duration"),
        F.round(safe_div("distance", "duration") * F.lit(60.0), 2).alias("avg_speed_kmh"),
        "n_items")
