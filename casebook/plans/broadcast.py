"""Broadcast only what is provably small.

A hint is given in three cases. A dictionary written as literal rows has a bound known
before any job runs. A dimension derived from data, joined on a handful of keys, is
counted and its bytes are estimated first (:func:`broadcast_if_small`, one job while the
query is built). A summary with at most a row for each range or heavy key is bounded by
the number of ranges (:mod:`casebook.operators.ranges`). Everything else is left to Spark's
optimizer (file sizes) and AQE (measured shuffle sizes), so a side that grows with the
data falls back to a shuffle join by itself. (A global aggregate attached to every row is
an uncorrelated scalar subquery, ``DataFrame.scalar()``, not a join.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest literal dictionary we agree to ship to every task.
MAX_LITERAL_ROWS = 10_000
# ... and its size for a dimension derived from data.
MAX_BYTES = 8 << 20


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str],
                  types: Sequence[str], max_rows: int = MAX_LITERAL_ROWS) -> DataFrame:
    """A small dimension from literal rows, cast to ``types`` and marked for
    broadcast. The bound is checked here, on the driver-side literal list, before any
    job runs."""
    if len(rows) > max_rows:
        raise ValueError(f"literal table of {len(rows)} rows exceeds the broadcast bound {max_rows}")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    names = ", ".join(columns)
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(columns, types))
    return F.broadcast(spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})"))


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_LITERAL_ROWS) -> DataFrame:
    """Broadcast a data-derived dimension only after checking its size, else leave
    the join to Spark (shuffle join, AQE skew handling).

    The check is one job over the (already reduced) dimension, for its rows and bytes. It is used
    for dimensions joined on a tiny key domain, such as pizza kinds or regions. There
    a shuffle join would hash every fact row onto a handful of keys, and AQE's runtime
    switch to a broadcast would come only after that shuffle had been written.
    """
    length = F.lit(0)
    for f in df.schema.fields:
        length = length + (F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() in ("string", "binary") else F.lit(8))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(length).alias("bytes")).first()
    return F.broadcast(df) if row["rows"] <= max_rows and (row["bytes"] or 0) <= MAX_BYTES else df
