"""Intervals, signed ledgers, running and daily balances, allocation
scenarios, interest.

Balance windows are partitioned by the customer and ordered by date; the daily
history is produced from the transaction days alone (each balance holds until the
day before the next transaction), so gap filling costs no join and no extra
shuffle: net, running balance and densification share one hash exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import as_list
from casebook.functions.dates import month_key
from casebook.functions.safe import pct
from casebook.operators.sequence import first_last_by
from casebook.operators.ordered import running_sum, trailing

OPEN_END = "9999-12-31"


# ---------------------------------------------------------------- O29

def interval_stats(df: DataFrame, start: str, end: str, by=None,
                   pcts: Sequence[float] = (0.5, 0.8, 0.95), names: Sequence[str] | None = None,
                   open_end: str | None = OPEN_END, include_open: bool = False,
                   avg_name: str | None = "avg_days", groups: DataFrame | None = None,
                   exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Mean and exact interpolated percentiles of ``end - start`` in days.

    Open intervals (``end == open_end``) are left out unless ``include_open`` (their
    length is meaningless and would swamp the mean). ``percentile`` keeps one count
    per distinct value in each partial aggregate; day counts have few distinct
    values, so the state stays small however many rows a group has. For lengths
    with many distinct values use ``exact=False``: ``percentile_approx`` keeps a
    fixed-size sketch per group (``accuracy``; it returns observed values, no
    interpolation). ``groups`` (a DataFrame with the ``by`` columns) lists groups
    to keep even when empty.
    """
    days = F.datediff(F.col(end), F.col(start))
    keep = F.lit(True) if include_open or open_end is None else (F.col(end) != F.lit(open_end).cast("date"))
    t = df.withColumn("_days", F.when(keep, days))
    names = list(names) if names else [f"p{int(round(p * 100))}_days" for p in pcts]
    if exact:
        aggs = [F.percentile("_days", F.lit(list(pcts))).alias("_p")]
    else:
        aggs = [F.percentile_approx("_days", list(pcts), accuracy).cast("array<double>").alias("_p")]
    if avg_name:
        aggs.append(F.avg("_days").alias(avg_name))
    g = t.groupBy(*as_list(by)) if by else t
    out = g.agg(*aggs)
    if groups is not None:
        # keep groups without any interval: attach the (small) aggregate to the group
        # list instead of outer-joining the group list to the raw intervals
        out = groups.select(*as_list(by)).distinct().join(out, as_list(by), "left")
    return out.select(*as_list(by), *([avg_name] if avg_name else []),
                      *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])


# ---------------------------------------------------------------- O30

def signed_amount(type_col: str, amount: str, credit: Sequence[str] = ("deposit",),
                  debit: Sequence[str] = ("purchase", "withdrawal")) -> Column:
    """+amount for credit types, -amount for debit types, 0 otherwise."""
    a = F.col(amount)
    return (F.when(F.col(type_col).isin(list(credit)), a)
             .when(F.col(type_col).isin(list(debit)), -a)
             .otherwise(F.lit(0)))


def signed_ledger(txns: DataFrame, key: str, date: str, type_col: str, amount: str,
                  period: str = "day", period_name: str | None = None, name: str = "net",
                  credit: Sequence[str] = ("deposit",),
                  debit: Sequence[str] = ("purchase", "withdrawal")) -> DataFrame:
    """Net amount per entity and period (``day``: the date itself; ``month``:
    'yyyy-MM'). Result type DECIMAL(18,2)."""
    pname = period_name or (date if period == "day" else "month")
    p = F.col(date) if period == "day" else month_key(date)
    return (txns.withColumn(pname, p).groupBy(key, pname)
                .agg(F.sum(signed_amount(type_col, amount, credit, debit)).cast("decimal(18,2)").alias(name)))


# ---------------------------------------------------------------- O31

def running_balance(net: DataFrame, key: str, order, value: str = "net",
                    name: str = "balance", bucket: Column | None = None, by_range: bool = False) -> DataFrame:
    """Cumulative sum of ``value`` per entity in ``order`` (explicit ORDER BY and
    ROWS frame: the result does not depend on row arrival order).

    With ``bucket`` (an expression non-decreasing in ``order``, e.g. the month): a
    two-level prefix sum for inputs where one entity has very many rows. Each
    (entity, bucket) total comes from a partial aggregate; an exclusive running
    total over the buckets (a window whose rows per entity are bounded by the number
    of buckets) gives each bucket its opening balance; the running sum inside each
    (entity, bucket) window partition is added to it. The hot entity's rows are then
    summed by many tasks. ``by_range`` does the same over equal ranges of the rows of
    heavy entities (:func:`casebook.operators.ordered.running_sum`).
    """
    order = as_list(order)
    if by_range:
        return running_sum(net, key, order, value, name)
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return net.withColumn(name, F.sum(value).over(w).cast("decimal(18,2)"))
    t = net.withColumn("_bkt", bucket)
    totals = t.groupBy(key, "_bkt").agg(F.sum(value).alias("_bt"))
    wb = Window.partitionBy(key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(key, "_bkt", F.coalesce(F.sum("_bt").over(wb), F.lit(0)).alias("_open"))
    w = Window.partitionBy(key, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (t.join(opening, [key, "_bkt"])
             .withColumn(name, (F.col("_open") + F.sum(value).over(w)).cast("decimal(18,2)"))
             .drop("_bkt", "_open"))


def transaction_balances(txns: DataFrame, key: str, date: str, type_col: str, amount: str,
                         bucket: Column | None = None, by_range: bool = False, **signs) -> DataFrame:
    """Every transaction with its ``impact`` (signed amount) and the ``balance`` after it.

    Within a day transactions go by type, then amount; those alike in all of it are
    interchangeable. ``bucket`` or ``by_range`` splits an entity with very many rows, see
    :func:`running_balance`."""
    t = txns.withColumn("impact", signed_amount(type_col, amount, **signs).cast("decimal(12,2)"))
    return running_balance(t, key, [date, type_col, amount], "impact", "balance", bucket, by_range)


def balance_range(balances: DataFrame, key: str, value: str = "balance") -> DataFrame:
    """Smallest, mean and largest ``value`` of each entity."""
    return balances.groupBy(key).agg(
        F.min(value).alias("min_balance"),
        (F.sum(value).cast("double") / F.count(value).cast("double")).alias("avg_balance"),
        F.max(value).alias("max_balance"))


# ---------------------------------------------------------------- O32

def growth_over_threshold(bal: DataFrame, key: str, order: str, value: str = "balance",
                          threshold: float = 0.05, n_name: str = "n_grew",
                          total_name: str = "n_customers", pct_name: str = "pct_grew",
                          base: str = "present") -> DataFrame:
    """Per period: entities whose ``value`` grew by more than ``threshold`` over
    their previous period, out of all entities present in the period (``base="present"``)
    or out of those that have a previous period (``base="previous"``; a period without
    any has a NULL share). Give densified periods for "previous" to mean the one before.

    A balance grew when v - prev > t * |prev| (exact in decimals, no division): a debt
    that shrinks is growth, one that deepens is not. A zero or missing previous value
    never counts.
    """
    w = Window.partitionBy(key).orderBy(order)
    prev = F.lag(value).over(w)
    t = bal.withColumn("_prev", prev)
    v, p, thr = F.col(value), F.col("_prev"), F.lit(threshold).cast("decimal(10,4)")
    grew = F.coalesce((p != 0) & ((v - p) > thr * F.abs(p)), F.lit(False))
    counted = F.count_if(p.isNotNull()) if base == "previous" else F.count(F.lit(1))
    return (t.groupBy(order).agg(F.count_if(grew).alias(n_name), counted.alias(total_name))
             .withColumn(pct_name, pct(n_name, total_name, 1)))


# ---------------------------------------------------------------- O35

def densify_daily(bal: DataFrame, key: str, date: str, value: str, end,
                  date_name: str = "bal_date", value_name: str = "balance") -> DataFrame:
    """One row per entity per day from its first row to ``end``, each day carrying
    the latest value on or before it (forward fill).

    ``bal`` has at most one row per (key, date). Each row is expanded to the days
    until the day before the entity's next row (``lead``) or ``end``; rows after
    ``end`` are dropped first. Narrow expansion, one window on the key. ``end`` is a
    date string or a date Column (e.g. a scalar subquery over the data).
    """
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    w = Window.partitionBy(key).orderBy(date)
    t = bal.filter(F.col(date) <= e).withColumn("_next", F.lead(date).over(w))
    last = F.coalesce(F.date_sub(F.col("_next"), 1), e)
    return t.select(F.col(key), F.explode(F.sequence(F.col(date), last)).alias(date_name),
                    F.col(value).alias(value_name))


def densify_months(bal: DataFrame, key: str, month: str, value: str, end_month=None,
                   value_name: str | None = None) -> DataFrame:
    """One row per entity per month ('yyyy-MM') from its first month to
    ``end_month``, each month carrying the latest value (forward fill): the monthly
    form of :func:`densify_daily`. ``end_month=None``: the latest month present in
    ``bal`` (a scalar subquery). Narrow expansion after one window on the key."""
    first_day = F.to_date(F.concat(F.col(month), F.lit("-01")))
    if end_month is None:
        end = F.to_date(F.concat(bal.agg(F.max(month)).scalar(), F.lit("-01")))
    else:
        end = F.to_date(F.lit(f"{end_month}-01"))
    w = Window.partitionBy(key).orderBy(month)
    # the end is projected into a column first (a scalar subquery may not sit
    # inside the higher-order function below)
    t = bal.withColumn("_m", first_day).withColumn("_end", end).filter(F.col("_m") <= F.col("_end")) \
           .withColumn("_next", F.lead("_m").over(w))
    last = F.coalesce(F.add_months(F.col("_next"), -1), F.col("_end"))
    months = F.sequence(F.col("_m"), last, F.expr("INTERVAL 1 MONTH"))
    labels = F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))
    return t.select(F.col(key), F.explode(labels).alias(month), F.col(value).alias(value_name or value))


def daily_balances(txns: DataFrame, key: str, date: str, type_col: str, amount: str, end=None,
                   credit: Sequence[str] = ("deposit",),
                   debit: Sequence[str] = ("purchase", "withdrawal")) -> DataFrame:
    """O30 + O31 + O35: customer_id, bal_date, balance DECIMAL(18,2) for every day
    from the entity's first transaction to ``end``. ``end=None``: the last day of
    the month of the latest transaction (a scalar subquery), so no transaction is
    ever left out."""
    if end is None:
        end = F.last_day(txns.agg(F.max(date)).scalar())
    net = signed_ledger(txns, key, date, type_col, amount, "day", date, "net", credit, debit)
    bal = running_balance(net, key, date, "net", "balance")
    return densify_daily(bal, key, date, "balance", end)


# ---------------------------------------------------------------- O36-O38

def allocation_period_end(daily: DataFrame, key: str = "customer_id", date: str = "bal_date",
                          value: str = "balance", floor: float = 0,
                          name: str = "data_required", months_later: int = 0) -> DataFrame:
    """Per month ('yyyy-MM'): sum over entities of their last balance of that month,
    floored at ``floor`` (no negative allocation). With ``months_later=1`` the sum stands
    at the month that is provisioned by it, the one after."""
    t = daily.withColumn("month", month_key(F.add_months(F.trunc(date, "month"), months_later)))
    last = first_last_by(t, [key, "month"], date, value, "last")
    return last.groupBy("month").agg(
        F.sum(F.greatest(F.col(value), F.lit(floor).cast("decimal(18,2)"))).cast("decimal(18,2)").alias(name))


def _min_avg_max(per_day: DataFrame, col: str, prefix: str) -> DataFrame:
    return per_day.agg(F.min(col).cast("decimal(18,2)").alias(f"{prefix}min"),
                       F.round(F.avg(F.col(col).cast("double")), 2).alias(f"{prefix}avg"),
                       F.max(col).cast("decimal(18,2)").alias(f"{prefix}max"))


def _by_month(per_day: DataFrame, date: str, col: str, prefix: str) -> DataFrame:
    t = per_day.select(month_key(date).alias("month"), F.col(col).cast("decimal(18,2)").alias("_total"))
    return t.groupBy("month").agg(
        F.min("_total").alias(f"{prefix}min"),
        (F.sum("_total").cast("double") / F.count(F.lit(1)).cast("double")).alias(f"{prefix}avg"),
        F.max("_total").alias(f"{prefix}max"))


def allocation_trailing(daily: DataFrame, key: str = "customer_id", date: str = "bal_date",
                        value: str = "balance", rows: int = 30, prefix: str = "daily_",
                        monthly: bool = False, by_range: bool = False) -> DataFrame:
    """Trailing mean of the last ``rows`` daily balances per entity, the day itself
    included (ordered by date), positive means summed per day, then min / avg / max over
    all days, or over the days of each month with ``monthly``. ``by_range`` splits heavy
    entities (:func:`casebook.operators.ordered.trailing`); give it a table that is
    cheap to read twice."""
    def mean(w) -> Column:
        return (F.sum(value).over(w) / F.count(F.lit(1)).over(w)).cast("decimal(24,6)")

    if by_range:
        t = trailing(daily.select(key, date, value), key, date, rows, {"_avg": mean})
    else:
        t = daily.withColumn("_avg", mean(Window.partitionBy(key).orderBy(date).rowsBetween(-(rows - 1), Window.currentRow)))
    t = t.select(date, "_avg").filter(F.col("_avg") > 0)
    per_day = t.groupBy(date).agg(F.sum("_avg").alias("_total"))
    return _by_month(per_day, date, "_total", prefix) if monthly else _min_avg_max(per_day, "_total", prefix)


def allocation_daily(daily: DataFrame, date: str = "bal_date", value: str = "balance",
                     prefix: str = "daily_", monthly: bool = False) -> DataFrame:
    """Positive balances summed per day, then min / avg / max over all days, or over the
    days of each month with ``monthly``."""
    per_day = daily.filter(F.col(value) > 0).groupBy(date).agg(F.sum(value).alias("_total"))
    return _by_month(per_day, date, "_total", prefix) if monthly else _min_avg_max(per_day, "_total", prefix)


# ---------------------------------------------------------------- O39

def accrue(daily: DataFrame, value: str = "balance", annual_rate: float = 0.06, days: int = 365,
           name: str = "data_allocation", digits: int | None = 2) -> DataFrame:
    """``value * (1 + annual_rate / days)`` (simple daily uplift, not compounding).
    The rate is computed in double: as a decimal literal 0.06/365 would be cut to
    six digits."""
    rate = F.lit(float(annual_rate)) / F.lit(float(days))
    v = F.col(value).cast("double") * (F.lit(1.0) + rate)
    return daily.withColumn(name, F.round(v, digits) if digits is not None else v)
