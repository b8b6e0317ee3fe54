"""Grouped measures: spend, shares, visits, top-k, time buckets, durations, pivots.

All aggregates here are algebraic (count/sum/min/max/avg, distinct via Spark's
two-phase rewrite), so Spark runs a partial aggregate before every shuffle: a hot
key costs one partial row per map task, not one task holding a third of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import as_column, as_list
from casebook.functions.dates import iso_weekday, minutes_between, days_between, month_key, week_of_year_block
from casebook.functions.safe import pct, safe_div
from casebook.functions.lists import list_size


# ---------------------------------------------------------------- O2

def spend_by_key(facts: DataFrame, dim: DataFrame, key: str, item: str, price: str,
                 count_name: str = "n_items", total_name: str = "total_spend",
                 pre_aggregate: bool = False) -> DataFrame:
    """Items bought and money spent per ``key``.

    ``facts`` has one row per item bought (``key``, ``item``); ``dim`` gives each
    item's ``price``. Facts whose item has no dimension row count as items with no
    spend (left join); facts without a ``key`` belong to nobody and are left out. With
    ``pre_aggregate`` the facts are first reduced to
    (key, item, count) -- worth it when the same key buys the same item many times;
    otherwise the extra exchange costs more than it saves.
    """
    d = dim.select(item, price)
    facts = facts.where(F.col(key).isNotNull())
    if pre_aggregate:
        pre = facts.groupBy(key, item).agg(F.count(F.lit(1)).alias("_n"))
        j = pre.join(d, item, "left")
        return j.groupBy(key).agg(F.sum("_n").alias(count_name),
                                  F.sum(F.col("_n") * F.col(price)).alias(total_name))
    j = facts.select(key, item).join(d, item, "left")
    return j.groupBy(key).agg(F.count(F.lit(1)).alias(count_name), F.sum(price).alias(total_name))


# ---------------------------------------------------------------- O3

def share_of_total(df: DataFrame, cond: Column, by=None, distinct: str | None = None,
                   digits: int | None = 1, within: str = "group",
                   n_name: str = "n", total_name: str = "total", pct_name: str = "pct") -> DataFrame:
    """Count of rows (or distinct ``distinct`` values) meeting ``cond`` and its share.

    ``within="group"``: the base is the group's own population (one pass, one
    aggregate). ``within="all"``: the base is the whole population, a global
    aggregate used as an uncorrelated scalar subquery (``DataFrame.scalar()``).
    """
    by = as_list(by)
    if distinct is not None and (within == "group" or not by):
        # one row per entity first: two distinct counts in one aggregate would write
        # every row twice before the shuffle
        per = df.groupBy(*by, distinct).agg(F.bool_or(cond).alias("_hit"))
        g = per.groupBy(*by) if by else per
        out = g.agg(F.count_if(F.col("_hit") & F.col(distinct).isNotNull()).alias(n_name),
                    F.count(distinct).alias(total_name))
        return out.withColumn(pct_name, pct(n_name, total_name, digits))
    if distinct is None:
        num, den = F.count_if(cond), F.count(F.lit(1))
    else:
        num, den = F.countDistinct(F.when(cond, F.col(distinct))), F.countDistinct(F.col(distinct))
    if within == "group" or not by:
        g = df.groupBy(*by) if by else df
        out = g.agg(num.alias(n_name), den.alias(total_name))
        return out.withColumn(pct_name, pct(n_name, total_name, digits))
    if distinct is None:
        # the base is the sum of the per-group populations: taken from the small
        # grouped result (its exchange is reused) instead of a second pass over df
        grouped = df.groupBy(*by).agg(num.alias(n_name), den.alias("_den"))
        total = grouped.agg(F.sum("_den")).scalar()
        grouped = grouped.drop("_den")
    else:
        grouped = df.groupBy(*by).agg(num.alias(n_name))
        total = df.agg(den).scalar()
    return grouped.withColumn(total_name, total).withColumn(pct_name, pct(n_name, total_name, digits))


# ---------------------------------------------------------------- O4

def visits(df: DataFrame, key: str, date: str, days_name: str = "n_visit_days",
           rows_name: str | None = "n_purchases") -> DataFrame:
    """Visits per entity: distinct days, and (``rows_name``) rows."""
    aggs = [F.countDistinct(date).alias(days_name)]
    if rows_name:
        aggs.append(F.count(F.lit(1)).alias(rows_name))
    return df.groupBy(key).agg(*aggs)


# ---------------------------------------------------------------- O6

def top_k_items(df: DataFrame, item, k: int = 1, by=None, count_name: str = "n",
                ties: str = "break", rank_name: str | None = None) -> DataFrame:
    """Most frequent ``item`` value(s), globally or per ``by`` key.

    Ties are broken by the item value ascending (``ties="break"``) or all tied items
    are kept (``ties="all"``). Global: ``TakeOrderedAndProject`` (each task keeps its
    own top k). Per key: a ``row_number``/``rank`` filter, which Spark plans with a
    partial ``WindowGroupLimit`` below the shuffle, so a hot key ships only k rows per
    map task.
    """
    items, by = as_list(item), as_list(by)
    counts = df.groupBy(*by, *items).agg(F.count(F.lit(1)).alias(count_name))
    order = [F.col(count_name).desc()] + [F.col(i).asc() for i in items]
    if not by:
        if ties == "all":
            # the k-th largest count (a scalar subquery), then every item reaching it
            kth = counts.orderBy(*order).limit(k).agg(F.min(count_name)).scalar()
            return counts.filter(F.col(count_name) >= kth)
        return counts.orderBy(*order).limit(k)
    # ties="all": rank on the count alone, so equal counts share a rank
    w = Window.partitionBy(*by).orderBy(*(order[:1] if ties == "all" else order))
    rk = F.rank() if ties == "all" else F.row_number()
    rn = rank_name or "_rk"
    out = counts.withColumn(rn, rk.over(w)).filter(F.col(rn) <= k)
    return out if rank_name else out.drop(rn)


# ---------------------------------------------------------------- O19

def time_bucket(col, unit: str) -> Column:
    """Bucket expression for ``time_bucket_counts``."""
    c = as_column(col)
    if unit == "hour":
        return F.hour(c)
    if unit == "weekday":
        return iso_weekday(c)
    if unit == "week_block":
        return week_of_year_block(c, 7)
    if unit == "month":
        return month_key(c)
    if unit == "year":
        return F.year(c)
    if unit == "date":
        return c.cast("date")
    raise ValueError(f"unknown unit {unit!r}")


def time_bucket_counts(df: DataFrame, ts: str, unit: str, by=None, name: str | None = None,
                       count_name: str = "n", distinct: str | None = None) -> DataFrame:
    """Row (or distinct ``distinct``) counts per time bucket (hour / weekday /
    7-day week of year / yyyy-MM / year / date), optionally within ``by``."""
    bname = name or unit
    agg = F.countDistinct(distinct) if distinct else F.count(F.lit(1))
    return (df.withColumn(bname, time_bucket(ts, unit))
              .groupBy(*as_list(by), bname).agg(agg.alias(count_name)))


# ---------------------------------------------------------------- O20 / O21

def duration_stats(df: DataFrame, start: str, end: str, unit: str = "minute", by=None,
                   prefix: str = "") -> DataFrame:
    """avg / min / max / range of elapsed time from ``start`` to ``end``.

    ``unit="minute"`` counts minute boundaries crossed; ``unit="day"`` whole days.
    Rows with a NULL end (e.g. cancelled) are ignored by the aggregates.
    """
    dur = minutes_between(start, end) if unit == "minute" else days_between(start, end)
    t = df.withColumn("_dur", dur)
    g = t.groupBy(*as_list(by)) if by else t
    return g.agg(F.avg("_dur").alias(f"{prefix}avg"), F.min("_dur").alias(f"{prefix}min"),
                 F.max("_dur").alias(f"{prefix}max"),
                 (F.max("_dur") - F.min("_dur")).alias(f"{prefix}range"))


def rate_stats(df: DataFrame, num: str, den: str, by=None, scale: float = 1.0,
               name: str = "avg_rate") -> DataFrame:
    """Average of ``scale * num / den`` (zero or NULL ``den`` rows ignored)."""
    t = df.withColumn("_rate", safe_div(num, den) * F.lit(scale))
    g = t.groupBy(*as_list(by)) if by else t
    return g.agg(F.avg("_rate").alias(name))


# ---------------------------------------------------------------- O24

def bucketize(df: DataFrame, col: str, width: int, cap: int | None = None,
              index_name: str = "bucket", label_name: str = "label", unit: str = "days") -> DataFrame:
    """Labelled ``width``-wide buckets: 0..width -> 1 ('0-30 days'), width+1..2w -> 2
    ('31-60 days'), ... With ``cap`` the last bucket is open ('180+ days')."""
    idx = F.greatest(F.ceil(F.col(col) / F.lit(width)), F.lit(1)).cast("int")
    if cap is not None:
        last = cap // width + 1
        idx = F.least(idx, F.lit(last))
    lo, hi = F.when(idx == 1, 0).otherwise((idx - 1) * width + 1), idx * width
    label = F.concat(lo.cast("string"), F.lit("-"), hi.cast("string"), F.lit(f" {unit}"))
    if cap is not None:
        label = F.when(idx == F.lit(cap // width + 1), F.lit(f"{cap}+ {unit}")).otherwise(label)
    return df.withColumn(index_name, idx).withColumn(label_name, label)


# ---------------------------------------------------------------- O18

def revenue_by(df: DataFrame, by, price: Column, extras: str | None = None,
               surcharge_per_extra: int | float = 0, name: str = "revenue",
               surcharge_name: str = "revenue_with_extras") -> DataFrame:
    """Revenue per group, plus revenue with a surcharge per listed extra (list
    size, so two-digit ids count once)."""
    aggs = [F.sum(price).alias(name)]
    if extras is not None:
        aggs.append(F.sum(price + F.lit(surcharge_per_extra) * list_size(extras)).alias(surcharge_name))
    return df.groupBy(*as_list(by)).agg(*aggs)


def change_flags(df: DataFrame, key, list_cols: Sequence[str]) -> DataFrame:
    """Per key: rows with at least one change (any list non-empty), rows without
    any change, and rows with all lists non-empty. A NULL list counts as empty."""
    sizes = [list_size(c) > 0 for c in list_cols]
    any_c, all_c = sizes[0], sizes[0]
    for s in sizes[1:]:
        any_c, all_c = any_c | s, all_c & s
    return df.groupBy(*as_list(key)).agg(F.count_if(any_c).alias("n_changed"),
                                       F.count_if(~any_c).alias("n_unchanged"),
                                       F.count_if(all_c).alias("n_both_changed"))


# ---------------------------------------------------------------- O28

def distinct_per_group(dim: DataFrame, facts: DataFrame, key: str, group_cols, counted: Mapping[str, str]) -> DataFrame:
    """Distinct counts of fact columns per dimension group, keeping groups without
    any fact (count 0). ``counted`` maps output name -> fact column.

    The facts meet the dimension in an inner join (the dimension side is the small
    one); each counted column is made distinct per group first and then counted, so
    that several of them multiply no rows, and only the per-group results are attached
    to the dimension's group list. Writing ``dim LEFT JOIN facts`` instead would hash
    every fact row onto the few group keys, a skew that AQE cannot split on the outer
    join's right side.
    """
    groups = as_list(group_cols)
    out = dim.select(*groups).distinct()
    for name, column in counted.items():
        pairs = facts.select(key, column).join(dim.select(key, *groups), key).select(*groups, column).distinct()
        out = out.join(pairs.groupBy(*groups).agg(F.count(column).alias(name)), groups, "left")
    return out.select(*groups, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in counted])


# ---------------------------------------------------------------- O33 / O34

def per_entity_average(df: DataFrame, key: str, cond: Column, value: str,
                       count_name: str = "avg_count", amount_name: str = "avg_amount") -> DataFrame:
    """Average over entities of their count and sum of rows meeting ``cond``
    (entities without such rows contribute 0)."""
    per = df.groupBy(key).agg(F.count_if(cond).alias("_n"),
                              F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0))).alias("_amt"))
    return per.agg(F.avg("_n").alias(count_name), F.avg("_amt").alias(amount_name))


def activity_rule(df: DataFrame, key: str, period: Column, category: str,
                  rules: Mapping[str, tuple[Sequence[str], int]], period_name: str = "month",
                  count_name: str = "n_customers", combine: str = "deposit_and_any") -> DataFrame:
    """Entities per period meeting count rules, evaluated per entity and period.

    ``rules`` maps a rule name to (categories, minimum count). The entity qualifies
    when the first rule holds AND any of the others holds (``combine``) or when all
    hold (``combine="all"``). Two-level aggregation: (period, key) first, then period.
    """
    per = (df.withColumn(period_name, period)
             .groupBy(period_name, key)
             .agg(*[F.count_if(F.col(category).isin(list(cats))).alias(f"_{n}") for n, (cats, _) in rules.items()]))
    conds = [F.col(f"_{n}") >= F.lit(m) for n, (_, m) in rules.items()]
    if combine == "all":
        ok = conds[0]
        for c in conds[1:]:
            ok = ok & c
    else:
        rest = conds[1] if len(conds) > 1 else F.lit(True)
        for c in conds[2:]:
            rest = rest | c
        ok = conds[0] & rest
    return per.groupBy(period_name).agg(F.count_if(ok).alias(count_name))


# ---------------------------------------------------------------- O40

def pivot_counts(df: DataFrame, key, column: str, values: Sequence, prefix: str = "n_") -> DataFrame:
    """One count column per listed value of ``column`` (a pivot with the values
    given up front: one aggregate, no extra job to discover them)."""
    return df.groupBy(*as_list(key)).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"{prefix}{v}") for v in values])
