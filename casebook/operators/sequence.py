"""Ordered events per entity: first/last, as-of, state transitions, states at a date.

"First" and "last" are computed as ``min``/``max`` of a struct whose leading fields
are the order columns: an ordinary aggregate with a partial (map-side) phase, so it
needs one shuffle and no per-key sort, and a hot key is pre-reduced on every task.
Every order ends with a tiebreak so the answer is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import as_list
from casebook.operators.ordered import neighbours
from casebook.operators.ranges import hot_and_rest


def _pick(order: Sequence[str], values: Sequence[str], which: str) -> Column:
    s = F.struct(*[F.col(c) for c in order], *[F.col(v) for v in values])
    return F.min(s) if which == "first" else F.max(s)


# ---------------------------------------------------------------- O5

def first_last_by(df: DataFrame, key, order, value, which: str = "first",
                  ties: str = "break", prefix: str | None = None) -> DataFrame:
    """First (or last) row per ``key`` by ``order``; returns key, order, value cols.

    ``ties="break"``: one row per key; ties on ``order`` go to the smallest (first) or
    largest (last) ``value``. ``ties="all"``: every row tied on the first/last
    ``order`` (deduplicated). The distinct rows meet each key's first order again by
    (key, order), a join that AQE broadcasts or splits where one key's first day is huge.
    """
    keys, order, values = as_list(key), as_list(order), as_list(value)
    if ties == "all":
        rows = df.select(*keys, *order, *values).distinct()
        o = [F.col(c).asc() if which == "first" else F.col(c).desc() for c in order]
        # a task keeps one row a key before the shuffle, so no key's rows are gathered
        one = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*o))).filter(F.col("_rn") == 1)
        found = one.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(order)]
        return rows.join(found, same, "left_semi")
    picked = df.groupBy(*keys).agg(_pick(order, values, which).alias("_p"))
    return picked.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in order + values])


# ---------------------------------------------------------------- O7

def asof_event(facts: DataFrame, anchors: DataFrame, key, fact_order, anchor_date: str,
               value, side: str = "after", inclusive: bool = False) -> DataFrame:
    """First fact after (or last fact before) each entity's anchor date.

    ``anchors`` holds at most one row per key (e.g. a membership table with a join
    date). The facts are first reduced to one row per key and day (a partial and final
    aggregate on both, so a hot key's rows are spread over its days); what meets the
    anchors has at most one row per key and calendar day. Entities without such a fact
    are absent (inner semantics: the question is about the events that exist).
    """
    keys, order, values = as_list(key), as_list(fact_order), as_list(value)
    which = "first" if side == "after" else "last"
    d = F.col(order[0])
    a = F.col(anchor_date)
    if side == "after":
        cond = d >= a if inclusive else d > a
    else:
        cond = d <= a if inclusive else d < a
    per_day = facts.groupBy(*keys, order[0]).agg(_pick(order[1:], values, which).alias("_day"))
    j = per_day.join(anchors.select(*keys, anchor_date), keys).filter(cond)
    picked = j.groupBy(*keys).agg(_pick([order[0]], ["_day"], which).alias("_p"))
    return picked.select(*keys, F.col(f"_p.{order[0]}").alias(order[0]),
                         *[F.col(f"_p._day.{c}").alias(c) for c in order[1:] + values])


def totals_before_anchor(facts: DataFrame, anchors: DataFrame, key, date: str, anchor_date: str,
                         amount: str, count_name: str = "n_items", amount_name: str = "amount_spent",
                         inclusive: bool = False, prices: DataFrame | None = None,
                         item: str | None = None) -> DataFrame:
    """Count and sum of ``amount`` of the facts dated before the anchor.

    With ``prices`` (``item`` -> ``amount``), the amount is looked up first. Items
    without a price count as items with no amount (left join). The facts are then
    reduced to one row per key and day before they meet the anchors, so a hot key's
    rows are spread over its days.
    """
    keys = as_list(key)
    cond = F.col(date) <= F.col(anchor_date) if inclusive else F.col(date) < F.col(anchor_date)
    if prices is not None:
        facts = facts.join(prices.select(item, amount), item, "left")
    per_day = facts.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_amount"))
    j = per_day.join(anchors.select(*keys, anchor_date), keys).filter(cond)
    return j.groupBy(*keys).agg(F.sum("_n").alias(count_name), F.sum("_amount").alias(amount_name))


# ---------------------------------------------------------------- O13

def shift_rows(df: DataFrame, key, order, cols, prev: bool = True, nxt: bool = True,
               bucket: Column | None = None, carry=(), by_range: bool = False) -> DataFrame:
    """Adds ``prev_<c>`` (lag) and/or ``next_<c>`` (lead) for each column of ``cols``,
    one row back/forward per ``key`` in ``order``, and ``last_<c>`` for each column
    of ``carry``: the last non-NULL value of ``c`` strictly before the row.

    Without ``bucket``: one window partitioned by the key (one hash exchange).

    With ``bucket`` (an expression non-decreasing in ``order``, e.g. the month of
    the date): a hot key is split into (key, bucket) window partitions, so its rows
    are processed by many tasks. Rows at a bucket edge take their neighbour (and the
    carried values) from a per-(key, bucket) summary: first row, last row and last
    non-NULL carried values, each a partial-aggregated ``min``/``max`` of a struct,
    shifted by one bucket with a window over the summary, whose rows per key are
    bounded by the number of buckets.

    With ``by_range`` heavy keys are split into equal ranges of their rows, however these
    are spread over time: see :func:`casebook.operators.ordered.neighbours`.
    """
    if by_range:
        return neighbours(df, key, order, cols, prev, nxt, carry)
    keys, order, cols, carry = as_list(key), as_list(order), as_list(cols), as_list(carry)
    ordered = [F.col(c) for c in order]
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*ordered)
        out = df
        for c in cols:
            if prev:
                out = out.withColumn(f"prev_{c}", F.lag(c).over(w))
            if nxt:
                out = out.withColumn(f"next_{c}", F.lead(c).over(w))
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        for c in carry:
            out = out.withColumn(f"last_{c}", F.last(c, ignorenulls=True).over(before))
        return out
    t = df.withColumn("_bkt", bucket)
    okey = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    edge = F.struct(*okey, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    aggs = [F.min(edge).alias("_first"), F.max(edge).alias("_last")]
    aggs += [F.max(F.when(F.col(c).isNotNull(), F.struct(*okey, F.col(c).alias("_v")))).alias(f"_lc{i}")
             for i, c in enumerate(carry)]
    summary = t.groupBy(*keys, "_bkt").agg(*aggs)
    wb = Window.partitionBy(*keys).orderBy("_bkt")
    wb_before = wb.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *keys, "_bkt", F.lag("_last").over(wb).alias("_prev_last"), F.lead("_first").over(wb).alias("_next_first"),
        *[F.last(F.col(f"_lc{i}")["_v"], ignorenulls=True).over(wb_before).alias(f"_carry{i}")
          for i in range(len(carry))])
    j = t.join(summary, [*keys, "_bkt"])
    w = Window.partitionBy(*keys, "_bkt").orderBy(*ordered)
    is_first = F.lag(F.lit(1)).over(w).isNull()
    is_last = F.lead(F.lit(1)).over(w).isNull()
    out = j
    for i, c in enumerate(cols):
        if prev:
            out = out.withColumn(f"prev_{c}", F.when(is_first, F.col("_prev_last")[f"_v{i}"]).otherwise(F.lag(c).over(w)))
        if nxt:
            out = out.withColumn(f"next_{c}", F.when(is_last, F.col("_next_first")[f"_v{i}"]).otherwise(F.lead(c).over(w)))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    for i, c in enumerate(carry):
        out = out.withColumn(f"last_{c}", F.coalesce(F.last(c, ignorenulls=True).over(before), F.col(f"_carry{i}")))
    return out.drop("_bkt", "_prev_last", "_next_first", *[f"_carry{i}" for i in range(len(carry))])


def plan_transitions(subs: DataFrame, key, date: str, state: str, tiebreak=None,
                     prev: bool = True, nxt: bool = True, bucket: Column | None = None, by_range: bool = False) -> DataFrame:
    """Adds ``prev_<state>``/``prev_<date>`` and ``next_<state>``/``next_<date>``.

    Ordered by ``date`` then ``tiebreak`` (two changes on one day need one). One
    hash exchange on ``key``; lag and lead share the same window. ``bucket`` (e.g.
    ``F.trunc(date, "month")``) or ``by_range`` splits hot keys, see :func:`shift_rows`.
    """
    return shift_rows(subs, key, [date, *as_list(tiebreak)], [state, date], prev, nxt, bucket, by_range=by_range)


def count_transitions(subs: DataFrame, key, date: str, state: str, frm, to, tiebreak=None,
                      year: int | None = None, name: str = "n_transitions",
                      bucket: Column | None = None, by_range: bool = False) -> DataFrame:
    """Number of changes ``frm`` -> ``to`` (consecutive states), optionally only the
    changes dated in ``year``. One row."""
    t = plan_transitions(subs, key, date, state, tiebreak, nxt=False, bucket=bucket, by_range=by_range)
    cond = (F.col(f"prev_{state}") == F.lit(frm)) & (F.col(state) == F.lit(to))
    if year is not None:
        cond = cond & (F.year(date) == F.lit(year))
    return t.agg(F.count_if(cond).alias(name))


# ---------------------------------------------------------------- O25

def time_between_states(subs: DataFrame, key, date: str, state: str, from_state, to_state,
                        name: str = "days") -> DataFrame:
    """Days from an entity's first ``from_state`` to its first ``to_state`` (entities
    having both, the second not before the first). One grouped pass with
    conditional minima instead of a self join of two filtered copies."""
    keys = as_list(key)
    per = subs.groupBy(*keys).agg(
        F.min(F.when(F.col(state) == F.lit(from_state), F.col(date))).alias("_from"),
        F.min(F.when(F.col(state) == F.lit(to_state), F.col(date))).alias("_to"))
    return (per.filter(F.col("_from").isNotNull() & F.col("_to").isNotNull() & (F.col("_to") >= F.col("_from")))
               .select(*keys, F.datediff("_to", "_from").alias(name)))


# ---------------------------------------------------------------- O26

def state_as_of(subs: DataFrame, key, date: str, state: str, as_of, inclusive: bool = True,
                tiebreak=None) -> DataFrame:
    """Each entity's state at ``as_of``: its last change dated on/before (or
    strictly before) that day. Entities with no change yet are absent."""
    keys = as_list(key)
    d = F.col(date)
    cutoff = F.lit(as_of).cast("date")
    f = subs.filter(d <= cutoff if inclusive else d < cutoff)
    return first_last_by(f, keys, [date, *as_list(tiebreak)], state, "last").select(*keys, state)


# ---------------------------------------------------------------- O27

def reached_only(subs: DataFrame, key, state: str, must, never: Sequence) -> DataFrame:
    """Entities that reached ``must`` and never any of ``never`` (one pass with
    boolean aggregates, i.e. the semi join / anti join pair without the joins)."""
    keys = as_list(key)
    per = subs.groupBy(*keys).agg(
        F.bool_or(F.col(state) == F.lit(must)).alias("_must"),
        F.bool_or(F.col(state).isin(list(never))).alias("_never"))
    return per.filter(F.col("_must") & ~F.col("_never")).select(*keys)


def reached_only_joins(subs: DataFrame, key, state: str, must, never: Sequence) -> DataFrame:
    """Same answer as :func:`reached_only`, written as IN / NOT IN: a left-semi join
    against the ``must`` set and a left-anti join against the ``never`` set (explicit
    anti join, not the null-aware NOT IN plan, which always broadcasts)."""
    keys = as_list(key)
    ents = subs.select(*keys).distinct()
    # the build sides are deduplicated (partial aggregation first), so a hot key is
    # one row there too: AQE can split only the probe side of a semi/anti join
    has = subs.filter(F.col(state) == F.lit(must)).select(*keys).distinct()
    bad = subs.filter(F.col(state).isin(list(never))).select(*keys).distinct()
    return ents.join(has, keys, "left_semi").join(bad, keys, "left_anti")


def reached_only_share(subs: DataFrame, key, state: str, must, never: Sequence,
                       n_name: str = "n_only", base_name: str = "n_reached",
                       pct_name: str = "pct_of_reached", digits: int = 1) -> DataFrame:
    """One row: entities that reached ``must`` without ever being in ``never``, all
    entities that reached ``must``, and the share. Two aggregates, no join."""
    keys = as_list(key)
    per = subs.groupBy(*keys).agg(
        F.bool_or(F.col(state) == F.lit(must)).alias("_must"),
        F.bool_or(F.col(state).isin(list(never))).alias("_never"))
    out = per.agg(F.count_if(F.col("_must") & ~F.col("_never")).alias(n_name),
                  F.count_if(F.col("_must")).alias(base_name))
    return out.withColumn(pct_name, F.round(F.try_divide(F.col(n_name) * F.lit(100.0), F.col(base_name)), digits))
