"""Recurring payment dates and the subscription billing ledger.

The source builds payment rows with six recursive CTEs, one per (current, next)
plan class. Here one row per subscription change is expanded in place: a
higher-order ``aggregate`` builds the array of payment dates and ``posexplode``
emits them, so the whole expansion is narrow (no join, no recursion, no shuffle).
The only exchange of the ledger is the hash partitioning on the customer that the
``lead``/``lag`` over change rows need (or, for hot customers, the (customer,
bucket) partitioning of :func:`casebook.operators.sequence.shift_rows`).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.operators.sequence import shift_rows


def payment_dates(start, end, step_months) -> Column:
    """``array<date>``: ``start``, then ``previous + step_months`` while the new date
    is strictly before ``end``. The first date is always present (even when
    ``end <= start`` or ``end`` is NULL). Each date is derived from the previous one,
    so a month-end start stays clamped ('sticky'): 31 Jan, 29 Feb, 29 Mar, ...
    (``sequence(start, end, interval)`` would restart from the 31st each month).
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    step = F.col(step_months) if isinstance(step_months, str) else F.lit(step_months) \
        if not isinstance(step_months, Column) else step_months
    n = F.greatest(F.coalesce(F.ceil(F.months_between(e, s) / step).cast("int"), F.lit(0)) + F.lit(2), F.lit(1))

    def grow(acc, _i):
        nxt = F.add_months(F.element_at(acc, -1), step)
        return F.when(e.isNotNull() & (nxt < e), F.concat(acc, F.array(nxt))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), n), F.array(s), grow)


def recurring_dates(df: DataFrame, start: str, end: str, step_months, out: str = "payment_date",
                    position: str | None = None) -> DataFrame:
    """One row per payment date (see :func:`payment_dates`); ``position`` (0-based)
    numbers them within the source row."""
    pos = position or "_pos"
    res = df.select("*", F.posexplode(payment_dates(start, end, step_months)).alias(pos, out))
    return res if position else res.drop(pos)


def billing_ledger(subs: DataFrame, plans: DataFrame, horizon: str, key: str = "customer_id",
                   date: str = "start_date", state: str = "plan_id", tiebreak: str | None = "sub_seq",
                   monthly: Sequence[int] = (1, 2), yearly: Sequence[int] = (3,),
                   upgrade_from: int = 1, upgrade_to: Sequence[int] = (2, 3),
                   credit: Decimal | float = Decimal("9.90"), bucket: Column | None = None, by_range: bool = False) -> DataFrame:
    """Every payment: customer_id, plan_id, payment_date, amount_paid DECIMAL(5,2).

    Rule: a paid plan bills on its start day and then every month (``monthly``) or
    year (``yearly``) while the date is before the customer's next change, or before
    ``horizon`` when there is none. A payment for an ``upgrade_to`` plan whose
    previous payment was for ``upgrade_from`` is reduced by ``credit``.

    The previous payment needs no window over payments: the payments of one paid
    change all fall before the next change, so the first payment of a change
    follows the last payment of the previous *paid* change, and every later payment
    follows one of its own plan. Both neighbours therefore come from windows over the
    change rows (bounded per key by the number of changes, and split by ``bucket`` or ``by_range``
    for hot keys); the payments themselves are generated narrowly and never sorted.
    """
    tb = [tiebreak] if tiebreak else []
    paid_states = list(monthly) + list(yearly)
    base = subs.select(key, date, state, *tb).withColumn(
        "_paid", F.when(F.col(state).isin(paid_states), F.col(state)))
    # one pass over the change rows: the next change (any plan) and the plan of the
    # last earlier paid change (a carried last-non-NULL value)
    t = shift_rows(base, key, [date, *tb], [date], prev=False, nxt=True, bucket=bucket, carry=["_paid"], by_range=by_range)
    paid = t.filter(F.col(state).isin(paid_states)).withColumnRenamed("last__paid", f"prev_{state}")
    step = F.when(F.col(state).isin(list(yearly)), F.lit(12)).otherwise(F.lit(1))
    end = F.coalesce(F.col(f"next_{date}"), F.lit(horizon).cast("date"))
    pay = paid.select(key, state, f"prev_{state}",
                      F.posexplode(payment_dates(F.col(date), end, step)).alias("_pos", "payment_date"))
    j = pay.join(plans.select(F.col("plan_id").alias(state) if state != "plan_id" else "plan_id", "price"), state)
    prev_payment_plan = F.when(F.col("_pos") == 0, F.col(f"prev_{state}")).otherwise(F.col(state))
    amount = F.when(F.col(state).isin(list(upgrade_to)) & (prev_payment_plan == F.lit(upgrade_from)),
                    F.col("price") - F.lit(credit)).otherwise(F.col("price"))
    return j.select(F.col(key).alias("customer_id"), F.col(state).alias("plan_id"), "payment_date",
                    amount.cast("decimal(5,2)").alias("amount_paid"))
