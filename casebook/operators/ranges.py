"""Ordered work cut into equal ranges of rows, not into periods of the calendar.

``cut`` sorts a table over the cluster and keeps each row's place; ``number_rows`` turns
places into dense numbers; ``heavy_keys`` names the keys that hold more than a task's
share of rows, and ``hot_and_rest`` sends only those through ranges. A window over one
range of a key is one task's work however many rows the key has; what crosses a range's
edge comes from a summary of one row for each key and range.

The cut is written before anything is computed from it, because the sampled edges of a
range shuffle differ from run to run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import as_list
from casebook.sources.io import stage_table

# rows looked at for each key that may be heavy
SAMPLE_ROWS = 400
# the place is (range << 33) + the row's number in its range
RANGE_BITS = 33


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame, order: Sequence[str | Column], name: str = "cut", place: str = "_at", part: str = "_part",
        parts: int | None = None) -> DataFrame:
    """``df`` sorted by ``order`` and cut into ``parts`` ranges of about as many rows each
    (default: the shuffle partitions); adds each row's ``place`` in the order, ascending
    over all rows, and the number of its range. Rows equal in all of ``order`` share a
    range, so end it with something unique where many rows may be alike. Staged."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(parts or _tasks(df), *order).sortWithinPartitions(*order)
    staged = stage_table(ranged.withColumn(place, F.monotonically_increasing_id()), name)
    return staged.withColumn(part, F.shiftright(place, RANGE_BITS))


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_number", start: int = 1,
                parts: int | None = None) -> DataFrame:
    """Adds the dense number of each row in ``order`` over the whole table (``start``,
    ``start + 1``, ...): ranges, then prefix sums of their row counts. Nothing runs in one
    task; the driver sees one count for each range. ``order`` must be total."""
    t = cut(df, order, "numbered", "_at", "_part", parts)
    before, opening = start, []
    for row in t.groupBy("_part").count().orderBy("_part").collect():  # one row a range
        opening.append((row["_part"], before - (row["_part"] << RANGE_BITS)))
        before += row["count"]
    offsets = df.sparkSession.createDataFrame(opening, "_part long, _shift long")
    return t.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def heavy_keys(df: DataFrame, key, share: float = 0.5, parts: int | None = None) -> DataFrame | None:
    """The keys with more than about ``share`` of an average task's rows, or None. There
    can be only some ``parts / share`` of them, whatever the data.

    Large tables are counted on a sample of ``SAMPLE_ROWS`` rows for each such key there may
    be: which keys are found changes how the work is spread, never a result."""
    keys, parts = as_list(key), parts or _tasks(df)
    total = df.count()
    fraction = min(1.0, SAMPLE_ROWS * parts / share / max(total, 1))
    some = df.select(*keys) if fraction == 1.0 else df.select(*keys).sample(fraction, seed=1)
    least = total * share / parts * fraction * (1.0 if fraction == 1.0 else 0.8)  # not to miss one by chance
    found = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > least).select(*keys)
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def hot_and_rest(df: DataFrame, key, rest: Callable[[DataFrame], DataFrame], hot: Callable[[DataFrame], DataFrame],
                 share: float = 0.5, parts: int | None = None) -> DataFrame:
    """``rest`` over the rows of ordinary keys, ``hot`` over those of heavy ones, together.
    Both must return the same columns. Null keys are keys like others."""
    keys = as_list(key)
    heavy = heavy_keys(df, keys, share, parts)
    if heavy is None:
        return rest(df)
    h = F.broadcast(heavy.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    return rest(df.join(h, same, "left_anti")).unionByName(hot(df.join(h, same, "left_semi")))
