"""Typed columns from text, with an account of what does not convert."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import as_list
from casebook.functions.text import DEFAULT_NULL_TOKENS, null_tokens


def _cells(df: DataFrame, types: Mapping[str, str], keys: Sequence[str], tokens: Iterable[str]) -> DataFrame:
    """One row for each text that is neither null-like nor converts."""
    bad = [F.when(null_tokens(c, tokens).isNotNull() & F.col(c).try_cast(t).isNull(),
                  F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("wanted_type"), F.col(c).alias("text"))) for c, t in types.items()]
    return df.select(*keys, F.explode(F.array_compact(F.array(*bad))).alias("_cell")).select(*keys, "_cell.*")


def split_typed(df: DataFrame, types: Mapping[str, str], key, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(typed, quarantine). ``typed`` has every row, with the columns of ``types`` cast;
    null-like texts are null, and so is a text that does not convert. Each of the latter
    is a row of ``quarantine``: the key, column_name, wanted_type and the text itself.

    Both are narrow projections of ``df``; stage it first if it is costly."""
    tokens = tuple(tokens)
    typed = df.withColumns({c: null_tokens(c, tokens).try_cast(t) for c, t in types.items()})
    return typed, _cells(df, types, as_list(key), tokens)


def account(df: DataFrame, types: Mapping[str, str], tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """One row for each column of ``types``: how many texts were null-like, converted, or
    went to quarantine; the three add up to the rows."""
    tokens = tuple(tokens)
    states = F.array(*[F.struct(F.lit(c).alias("column_name"), null_tokens(c, tokens).isNull().alias("empty"), F.col(c).try_cast(t).isNotNull().alias("typed")) for c, t in types.items()])
    cells = df.select(F.explode(states).alias("s")).select("s.*")
    return cells.groupBy("column_name").agg(F.count_if("empty").alias("n_empty"), F.count_if(~F.col("empty") & F.col("typed")).alias("n_typed"),
                                            F.count_if(~F.col("empty") & ~F.col("typed")).alias("n_quarantined"))
