"""Arithmetic that does not fail under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.columns import as_column


def safe_div(num, den) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL (``NULLIF`` rule)."""
    return F.try_divide(as_column(num).cast("double"), F.nullif(as_column(den).cast("double"), F.lit(0.0)))


def pct(num, den, digits: int | None = 1) -> Column:
    """Percentage ``100 * num / den`` rounded to ``digits``; NULL for a zero base."""
    v = safe_div(as_column(num).cast("double") * F.lit(100.0), den)
    return F.round(v, digits) if digits is not None else v
