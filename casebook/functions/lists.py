"""Delimited lists held in a string column ('1, 5', '11,2', 'null', '')."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.text import DEFAULT_NULL_TOKENS, null_tokens


def split_list(col, sep: str = ",", as_type: str = "int",
               tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """Parse a delimited list into ``array<as_type>``.

    NULL-like text -> NULL (no list at all). Each element is trimmed and safely cast;
    elements that are not valid values (``'x'``) are dropped. Order and repeats are
    kept: ``'1, 1'`` -> ``[1, 1]``.
    """
    cleaned = null_tokens(col, tokens)
    parts = F.split(cleaned, sep if sep not in ".|*+?()[]{}^$\\" else "\\" + sep)
    typed = F.transform(parts, lambda x: F.trim(x).try_cast(as_type))
    return F.filter(typed, lambda x: x.isNotNull())


def list_size(col) -> Column:
    """Number of entries of a parsed list; a NULL list counts as 0 (tested
    explicitly: with ANSI mode off, ``size(NULL)`` is -1, not NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))
