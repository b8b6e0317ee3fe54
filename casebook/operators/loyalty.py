"""Rule-based loyalty points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loyalty_points(facts: DataFrame, menu: DataFrame, key: str, date: str, item: str,
                   item_name: str, price: str, base: int = 10,
                   special_items: Sequence[str] = (), special_multiplier: int = 2,
                   members: DataFrame | None = None, join_date: str = "join_date",
                   window_days: int | None = None, window_multiplier: int = 2,
                   until: str | None = None, name: str = "points") -> DataFrame:
    """Points per customer: ``price * base`` per item bought, times
    ``special_multiplier`` for ``special_items``.

    With ``members`` and ``window_days``: only members are scored and every item
    bought in the first ``window_days`` days of membership (join day included:
    ``join_date <= date < join_date + window_days``) earns ``window_multiplier``
    (multipliers do not stack; the larger applies). ``until`` keeps purchases up to
    and including that date. Items missing from the menu earn nothing.

    Plan: fact scan (the ``until`` filter reaches the scan) -> join menu -> one
    partial+final aggregate on ``key``. With members, the priced facts are first
    reduced to one row per key and day, so a hot customer's rows are spread over its
    days before they meet the members. Join strategies are left to Spark/AQE.
    """
    f = facts.select(key, date, item)
    if until is not None:
        f = f.filter(F.col(date) <= F.lit(until).cast("date"))
    j = f.join(menu.select(item, item_name, price), item)
    special = F.coalesce(F.col(item_name).isin(list(special_items)), F.lit(False))
    if members is None:
        mult = F.when(special, F.lit(special_multiplier)).otherwise(F.lit(1))
        return j.groupBy(key).agg(F.sum(F.col(price) * F.lit(base) * mult).alias(name))
    per_day = j.groupBy(key, date).agg(F.sum(F.when(special, F.col(price))).alias("_special"),
                                       F.sum(F.when(~special, F.col(price))).alias("_other"))
    m = per_day.join(members.select(key, join_date), key)
    bonus = F.lit(1)
    if window_days is not None:
        in_window = ((F.col(date) >= F.col(join_date)) &
                     (F.col(date) < F.date_add(F.col(join_date), window_days)))
        bonus = F.greatest(bonus, F.when(in_window, F.lit(window_multiplier)).otherwise(F.lit(1)))
    points = (F.coalesce("_special", F.lit(0)) * F.greatest(F.lit(special_multiplier), bonus)
              + F.coalesce("_other", F.lit(0)) * bonus)
    return m.groupBy(key).agg(F.sum(points * F.lit(base)).alias(name))


def flat_bonus_points(facts: DataFrame, menu: DataFrame, members: DataFrame, key: str, date: str, item: str, item_name: str, price: str,
                      special_items: Sequence[str] = (), base: int = 10, bonus: int = 10, join_date: str = "join_date", name: str = "points") -> DataFrame:
    """Points of members from the day they join: ``price * base`` per item bought, and once
    ``bonus`` for each special item a member has bought at all (no multiplier).

    One row per key, day and item name comes before the member join, as above."""
    j = facts.select(key, date, item).join(menu.select(item, item_name, price), item)
    per_day = j.groupBy(key, date, item_name).agg(F.sum(price).alias("_spent"))
    own = per_day.join(members.select(key, join_date), key).filter(F.col(date) >= F.col(join_date))
    per_item = own.groupBy(key, item_name).agg(F.sum("_spent").alias("_spent"))
    extra = F.when(F.col(item_name).isin(list(special_items)), F.lit(bonus)).otherwise(F.lit(0))
    return per_item.groupBy(key).agg((F.sum("_spent") * F.lit(base) + F.sum(extra)).alias(name))
