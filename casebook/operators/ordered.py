"""Windows over an entity's rows whose work does not grow with one entity.

Each function takes an entity's rows in order: ordinary entities in one window, heavy ones
(more than half a task's share of rows, see :mod:`casebook.operators.ranges`) in equal
ranges of their rows. What crosses the edge of a range comes from a summary of one row for
each heavy entity and range, at most ranges + heavy entities rows, so it can be broadcast:

* neighbours and carried values: the edge rows of the ranges before and after;
* running sums: the sum of all ranges before;
* moving frames: the last rows of the ranges before, copied (a halo);
* compound interest: each range is one affine map of the balance it starts with; the maps
  are composed in order, then applied;
* the value in force at a time: facts and changes in one ordered stream, with the last
  change carried on.

``order`` should be total within an entity. Null entities are an entity like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import as_list
from casebook.operators.ranges import cut, hot_and_rest


def _window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _add(ranged: DataFrame, keys: Sequence[str], summary: DataFrame) -> DataFrame:
    """Each row with the summary of its range (at most ranges + heavy keys rows)."""
    h = summary.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), *[c for c in summary.columns if c not in {*keys, "_part"}])
    same = ranged["_part"] == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return ranged.join(F.broadcast(h), same).drop("_p", *[f"_k{i}" for i in range(len(keys))])


# ---------------------------------------------------------------- neighbours, carried values

def neighbours(df: DataFrame, key, order, cols=(), prev: bool = True, nxt: bool = True, carry=(), parts: int | None = None) -> DataFrame:
    """Adds ``prev_<c>`` and/or ``next_<c>`` for each of ``cols`` (the row before and after)
    and ``last_<c>`` for each of ``carry`` (the last non-null value before the row)."""
    keys, order, cols, carry = as_list(key), as_list(order), as_list(cols), as_list(carry)

    def shifted(t: DataFrame, w) -> DataFrame:
        new = {}
        for c in cols:
            if prev:
                new[f"prev_{c}"] = F.lag(c).over(w)
            if nxt:
                new[f"next_{c}"] = F.lead(c).over(w)
        new |= {f"last_{c}": F.last(c, ignorenulls=True).over(_before(w)) for c in carry}
        return t.withColumns(new) if new else t

    def hot(t: DataFrame) -> DataFrame:
        t = cut(t, [*keys, *order], "neighbours", parts=parts)
        row = F.struct(F.lit(1).alias("row"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
        held = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_c{i}") for i, c in enumerate(carry)]
        edges = t.groupBy(*keys, "_part").agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.min_by(row, "_at").alias("_first"), F.max_by(row, "_at").alias("_last"), *held)
        w = _window(keys, ["_part"])
        edges = edges.select(*keys, "_part", "_from", "_to", F.lag("_last").over(w).alias("_earlier"), F.lead("_first").over(w).alias("_later"),
                             *[F.last(f"_c{i}", ignorenulls=True).over(_before(w)).alias(f"_held{i}") for i in range(len(carry))])
        t = _add(shifted(t, _window([*keys, "_part"], ["_at"])), keys, edges)
        new = {}
        for i, c in enumerate(cols):
            if prev:
                new[f"prev_{c}"] = F.when(F.col("_at") == F.col("_from"), F.col("_earlier")[f"_v{i}"]).otherwise(F.col(f"prev_{c}"))
            if nxt:
                new[f"next_{c}"] = F.when(F.col("_at") == F.col("_to"), F.col("_later")[f"_v{i}"]).otherwise(F.col(f"next_{c}"))
        new |= {f"last_{c}": F.coalesce(f"last_{c}", f"_held{i}") for i, c in enumerate(carry)}
        return (t.withColumns(new) if new else t).drop("_at", "_part", "_from", "_to", "_earlier", "_later", *[f"_held{i}" for i in range(len(carry))])

    return hot_and_rest(df, keys, lambda t: shifted(t, _window(keys, order)), hot, parts=parts)


# ---------------------------------------------------------------- running sums

def running_sum(df: DataFrame, key, order, value: str, name: str, as_type: str = "decimal(18,2)", parts: int | None = None) -> DataFrame:
    """Adds the sum of ``value`` over the entity's rows up to this one."""
    keys, order = as_list(key), as_list(order)

    def upto(w) -> Column:
        return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def hot(t: DataFrame) -> DataFrame:
        t = cut(t, [*keys, *order], "running", parts=parts)
        totals = t.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
        opening = totals.select(*keys, "_part", F.sum("_sum").over(_before(_window(keys, ["_part"]))).alias("_opening"))
        own = _add(t.withColumn("_own", upto(_window([*keys, "_part"], ["_at"]))), keys, opening)
        # no value so far is null, not 0
        both = F.when(F.col("_own").isNull(), F.col("_opening")).otherwise(F.col("_own") + F.coalesce("_opening", F.lit(0)))
        return own.withColumn(name, both.cast(as_type)).drop("_own", "_opening", "_at", "_part")

    return hot_and_rest(df, keys, lambda t: t.withColumn(name, upto(_window(keys, order)).cast(as_type)), hot, parts=parts)


# ---------------------------------------------------------------- numbers within an entity

def numbered(df: DataFrame, key, order, name: str, as_type: str = "int", parts: int | None = None) -> DataFrame:
    """Adds the row's number within its entity (from 1). Ordinary entities stay hashed by
    the key, so a join on it that follows needs no other exchange."""
    keys, order = as_list(key), as_list(order)

    def hot(t: DataFrame) -> DataFrame:
        t = cut(t, [*keys, *order], "numbered", parts=parts)
        sizes = t.groupBy(*keys, "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
        before = F.coalesce(F.sum("_n").over(_before(_window(keys, ["_part"]))), F.lit(0))
        t = _add(t, keys, sizes.select(*keys, "_part", (before + 1 - F.col("_from")).alias("_shift")))
        return t.withColumn(name, (F.col("_at") + F.col("_shift")).cast(as_type)).drop("_at", "_part", "_shift")

    return hot_and_rest(df, keys, lambda t: t.withColumn(name, F.row_number().over(_window(keys, order)).cast(as_type)), hot, parts=parts)


# ---------------------------------------------------------------- moving frames

def trailing(df: DataFrame, key, order, rows: int, new: dict, parts: int | None = None) -> DataFrame:
    """Adds aggregates over the last ``rows`` rows, the row itself included: ``new`` maps a
    name to a function of the window, e.g. ``{"mean": lambda w: F.avg("x").over(w)}``.

    In a range the frame needs up to ``rows - 1`` rows of the ranges before it, which are
    copied there; a range shorter than that is passed over to the one before."""
    keys, order = as_list(key), as_list(order)

    def framed(t: DataFrame, w) -> DataFrame:
        frame = w.rowsBetween(1 - rows, Window.currentRow)
        return t.withColumns({n: f(frame) for n, f in new.items()})

    def hot(t: DataFrame) -> DataFrame:
        t = cut(t, [*keys, *order], "trailing", parts=parts)
        sizes = t.groupBy(*keys, "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
        w = _window(keys, ["_part"])
        starts = F.collect_list(F.struct(F.col("_start").alias("start"), F.col("_part").alias("part"))).over(Window.partitionBy(*keys))
        summary = (sizes.withColumn("_start", F.coalesce(F.sum("_n").over(_before(w)), F.lit(0)))
                   .withColumn("_all", starts).drop("_n"))
        t = _add(t, keys, summary)
        nth = F.col("_start") + F.col("_at") - F.col("_from")  # rows of a key are neighbours within a range
        t = t.withColumn("_nth", nth)
        later = F.filter("_all", lambda s: (s["start"] > F.col("_nth")) & (s["start"] < F.col("_nth") + rows))
        parts_of = F.concat(F.array(F.col("_part")), F.transform(later, lambda s: s["part"]))
        t = t.drop("_from", "_start").withColumn("_to", F.explode(parts_of)).drop("_all")
        out = framed(t, _window([*keys, "_to"], ["_nth"]))
        return out.where(F.col("_to") == F.col("_part")).drop("_at", "_part", "_nth", "_to")

    return hot_and_rest(df, keys, lambda t: framed(t, _window(keys, order)), hot, parts=parts)


# ---------------------------------------------------------------- compound interest

CLOSED = "array<struct<part:bigint,end:date,opening:double,closing:double>>"  # ranges done so far


def compound(df: DataFrame, key, date: str, net: str, annual_rate: float = 0.06, days: int = 365, name: str = "balance",
             tiebreak=(), parts: int | None = None) -> DataFrame:
    """Adds the balance after each row when it earns ``annual_rate / days`` on every day,
    compounded: balance = earlier balance x (1 + rate)**(days since) + net.

    Rows need not be daily: quiet days are in the exponent. Within a range the sum of
    net / (1 + rate)**(days from its start) is a running sum, times (1 + rate)**(days from
    its start): the range's affine map. In doubles, so (1 + rate)**(days of the whole
    history) must stay below 1e300. A negative balance pays the same rate."""
    keys, order = as_list(key), [date, *as_list(tiebreak)]
    growth = F.lit(1.0 + float(annual_rate) / float(days))

    def since(start: Column) -> Column:
        return F.pow(growth, F.datediff(F.col(date), start).cast("double"))

    def within(w, start: Column) -> Column:
        paid = F.coalesce(F.col(net).cast("double"), F.lit(0.0))
        return F.sum(paid / since(start)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) * since(start)

    def rest(t: DataFrame) -> DataFrame:
        t = t.withColumn("_start", F.min(date).over(Window.partitionBy(*keys)))
        return t.withColumn(name, within(_window(keys, order), F.col("_start"))).drop("_start")

    def hot(t: DataFrame) -> DataFrame:
        t = cut(t, [*keys, *order], "compound", parts=parts)
        span = t.groupBy(*keys, "_part").agg(F.min(date).alias("_start"), F.max(date).alias("_end"))
        t = _add(t, keys, span.drop("_end"))
        paid = F.coalesce(F.col(net).cast("double"), F.lit(0.0))
        adds = t.groupBy(*keys, "_part").agg(F.sum(paid / since(F.col("_start"))).alias("_adds"))
        maps = _add(span, keys, adds)
        # what a range adds, seen at its end; then range after range
        value = (F.col("_adds") * F.pow(growth, F.datediff("_end", "_start").cast("double"))).alias("adds")
        chain = maps.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_part").alias("part"), F.col("_start").alias("start"), F.col("_end").alias("end"), value))).alias("chain"))

        def apply(done, m):
            last = F.element_at(done, -1)
            at_start = F.coalesce(last["closing"] * F.pow(growth, F.datediff(m["start"], last["end"]).cast("double")), F.lit(0.0))
            closing = at_start * F.pow(growth, F.datediff(m["end"], m["start"]).cast("double")) + m["adds"]
            return F.concat(done, F.array(F.struct(m["part"].alias("part"), m["end"].alias("end"), at_start.alias("opening"), closing.alias("closing"))))

        first = F.col("chain")[0]
        begun = F.array(F.struct(first["part"].alias("part"), first["end"].alias("end"), F.lit(0.0).alias("opening"), first["adds"].alias("closing"))).cast(CLOSED)
        done = F.aggregate(F.expr("slice(chain, 2, size(chain) - 1)"), begun, lambda a, m: apply(a, m).cast(CLOSED))
        opening = chain.select(*keys, F.explode(done).alias("m")).select(*keys, F.col("m.part").alias("_part"), F.col("m.opening").alias("_opening"))
        t = _add(t, keys, opening)
        own = within(_window([*keys, "_part"], ["_at"]), F.col("_start"))
        return t.withColumn(name, F.col("_opening") * since(F.col("_start")) + own).drop("_start", "_opening", "_at", "_part")

    return hot_and_rest(df, keys, rest, hot, parts=parts)


# ---------------------------------------------------------------- the value in force

def in_force(facts: DataFrame, changes: DataFrame, key, time: str, change_time: str, values, tiebreak=(), inclusive: bool = True,
             parts: int | None = None) -> DataFrame:
    """Each row of ``facts`` with the ``values`` of the entity's last change at or before
    its ``time`` (before it with ``inclusive=False``); null if there is none.

    An entity may have any number of changes: facts and changes are one ordered stream,
    so nothing is joined entity by entity. Of changes at one time the last by ``tiebreak``
    counts. Facts without a time have no value; changes without one are left out."""
    keys, values, ties = as_list(key), as_list(values), as_list(tiebreak)
    fact = facts.select(F.struct("*").alias("_fact"), *keys, F.col(time).alias("_time"))
    held = F.struct(*[F.col(v).alias(v) for v in values])
    change = changes.where(F.col(change_time).isNotNull()).select(*keys, F.col(change_time).alias("_time"), held.alias("_change"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)])
    kind = {"_kind": F.lit(1)}
    stream = fact.withColumns(kind).unionByName(change.withColumn("_kind", F.lit(0 if inclusive else 2)), allowMissingColumns=True)
    out = neighbours(stream, keys, ["_time", "_kind", *[f"_tie{i}" for i in range(len(ties))]], carry=["_change"], parts=parts)
    return out.where(F.col("_fact").isNotNull()).select("_fact.*", *[F.col("last__change")[v].alias(v) for v in values])
