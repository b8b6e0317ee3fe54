"""Exact percentiles by distributed selection.

An aggregate that computes an exact percentile keeps all distinct values of its group in
one task. Here values are counted, sorted over the cluster and cut into ranges; the row
counts of the ranges tell which range holds each wanted rank, and only there a running
count finds the value. State is one range, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import as_list
from casebook.operators.ranges import cut


def _ranks(total: Column, points: Mapping[str, float]) -> Column:
    at = [F.lit(float(p)) * (total - 1) for p in points.values()]
    return F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)]))


def quantiles(df: DataFrame, by, value: str, points: Mapping[str, float], parts: int | None = None) -> DataFrame:
    """One row for each group of ``by`` (one in all without) that has a value: a double
    for each name of ``points`` at that share of the group's non-null values, linear
    between two neighbours, as ``percentile`` has it."""
    by = as_list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    t = cut(counts, [*by, value], "quantiles", parts=parts)
    group = [F.col(c) for c in by] or [F.shiftright("_at", 62)]  # one group, but not a constant
    t = t.withColumn("_group", F.struct(*group))
    # one row for each group and range
    w = Window.partitionBy("_group")
    sizes = t.groupBy("_group", "_part").agg(F.sum("_n").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumns({"_before": before, "_total": F.sum("_rows").over(w)})
    wanted = F.filter(_ranks(F.col("_total"), points), lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_rows")))
    hits = sizes.withColumn("_wanted", wanted).where(F.size("_wanted") > 0).select("_group", "_part", "_before", "_total", "_wanted")
    # only ranges that hold a wanted rank are read on; a struct key takes null groups as equal
    upto = F.sum("_n").over(Window.partitionBy("_group", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    held = t.join(hits, ["_group", "_part"]).withColumn("_upto", upto + F.col("_before"))
    mine = F.filter("_wanted", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_n")))
    found = held.select("_group", "_total", F.explode(mine).alias("rank"), F.col(value).cast("double").alias("value"))
    values = F.map_from_entries(F.collect_list(F.struct("rank", "value")))  # at most two a point
    per = found.groupBy("_group").agg(F.max("_total").alias("_total"), values.alias("_values"))

    def at(p: float) -> Column:
        place = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
        first, last = F.col("_values")[low], F.col("_values")[high]
        return F.when(low == high, first).otherwise((high - place) * first + (place - low) * last)

    return per.select(*[F.col("_group")[c].alias(c) for c in by], *[at(p).alias(n) for n, p in points.items()])
