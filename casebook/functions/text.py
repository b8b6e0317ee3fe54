"""Cleaning of dirty text columns: null tokens, unit suffixes, safe parsing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.columns import as_column
from casebook.functions.safe import pct

# Spellings that stand for "missing" in the source systems.
DEFAULT_NULL_TOKENS = ("null", "")

# A leading signed decimal number, e.g. "23.4" in "23.4 km" or "25" in "25mins".
_LEADING_NUMBER = r"^\s*(-?[0-9]+(\.[0-9]+)?)"


def null_tokens(col, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """NULL when the trimmed, lower-cased text is one of ``tokens`` (or already NULL)."""
    c = as_column(col)
    toks = [t.lower() for t in tokens]
    return F.when(c.isNull() | F.lower(F.trim(c)).isin(toks), F.lit(None).cast("string")).otherwise(c)


def leading_number(col) -> Column:
    """Text of the leading number of ``col`` ('' when there is none)."""
    return F.regexp_extract(as_column(col), _LEADING_NUMBER, 1)


def parse_measure(col, to_type: str = "decimal(10,2)",
                  tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """'23.4 km' -> 23.4, '32 minutes' -> 32, '25mins' -> 25, 'null'/''/'n/a' -> NULL.

    The unit suffix is dropped by taking the leading number; the cast is a
    ``try_cast`` so a token that is not a number becomes NULL instead of failing the
    job under ANSI mode.
    """
    cleaned = null_tokens(col, tokens)
    return F.nullif(leading_number(cleaned), F.lit("")).try_cast(to_type)


def parse_timestamp(col, fmt: str = "yyyy-MM-dd HH:mm:ss",
                    tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """Dirty text -> TIMESTAMP_NTZ (the wall-clock time as written); tokens and
    unparseable text -> NULL.

    ``try_to_timestamp`` only decides validity: its value is an instant in the
    session time zone, which moves wall-clock times that fall into a daylight-saving
    gap. The value itself comes from ``to_timestamp_ntz``, which ignores time zones.
    """
    cleaned = null_tokens(col, tokens)
    f = F.lit(fmt)
    return F.when(F.try_to_timestamp(cleaned, f).isNotNull(), F.to_timestamp_ntz(cleaned, f))


def concat_nullsafe(*cols) -> Column:
    """String concatenation that treats NULL as '' (the T-SQL ``CONCAT`` rule)."""
    return F.concat(*[F.coalesce(as_column(c).cast("string"), F.lit("")) for c in cols])


def percent_text(num, den, digits: int = 1) -> Column:
    """'12.5%' style label, for display only (logic uses the numeric ``pct``)."""
    return F.concat(F.format_number(pct(num, den, digits), digits), F.lit("%"))
