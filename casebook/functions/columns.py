"""What a caller may give as a column name, a column, or a list of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_list(names) -> list[str]:
    """No, one or several column names as a list."""
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def as_column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
