"""Cleaning dirty columns, delimited lists, readable labels, line ids.

The source fixes dirty rows with in-place ``UPDATE``s and ``ALTER COLUMN``; here
each fix is a projection producing a clean, typed DataFrame (narrow: no shuffle).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import as_list
from casebook.functions.lists import split_list
from casebook.functions.text import DEFAULT_NULL_TOKENS, null_tokens, parse_measure, parse_timestamp


# ---------------------------------------------------------------- O9

def clean_nulls(df: DataFrame, cols: Iterable[str], tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Replace null-like tokens ('null', '', blanks) by real NULLs in ``cols``."""
    return df.withColumns({c: null_tokens(c, tokens) for c in cols})


def clean_runner_orders(raw: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Typed delivery table: pickup_time TIMESTAMP_NTZ, distance DECIMAL(10,2) (km,
    unit stripped), duration INT (minutes, unit stripped), cancellation STRING
    (NULL when not cancelled)."""
    return raw.withColumns({
        "pickup_time": parse_timestamp("pickup_time", ts_format),
        "distance": parse_measure("distance", "decimal(10,2)"),
        "duration": parse_measure("duration", "int"),
        "cancellation": null_tokens("cancellation"),
    })


def clean_customer_orders(raw: DataFrame, list_cols: Sequence[str] = ("exclusions", "extras"),
                          partition: str = "order_id", line_id: str | None = "line_id",
                          split_prefix: int = 0) -> DataFrame:
    """Parse the list columns into ``array<int>`` and (when ``line_id`` is given)
    number the lines of each order (see :func:`with_row_id`; numbered on the raw text
    so the id does not depend on how a list was spelled)."""
    numbered = with_row_id(raw, partition, name=line_id, split_prefix=split_prefix) if line_id else raw
    return numbered.withColumns({c: split_list(c) for c in list_cols})


# ---------------------------------------------------------------- O10

def explode_list(df: DataFrame, col: str, keep: Sequence[str] = (), sep: str = ",",
                 as_type: str = "int", out: str = "value", parsed: bool = False) -> DataFrame:
    """One row per list entry (the ``CROSS APPLY STRING_SPLIT`` pattern). NULL or
    empty lists give no rows; unparseable entries are dropped; repeats are kept."""
    arr = F.col(col) if parsed else split_list(col, sep, as_type)
    return df.select(*keep, F.explode(arr).alias(out))


def bridge_table(recipes: DataFrame, id_col: str = "pizza_id", list_col: str = "toppings",
                 out: str = "topping_id") -> DataFrame:
    """Normalise a list-in-a-string column into a (id, member) bridge table."""
    return explode_list(recipes, list_col, keep=[id_col], out=out)


# ---------------------------------------------------------------- O11

def dictionary_map(entries: Mapping[int, str] | Sequence[tuple[int, str]]) -> Column:
    """A literal ``map<int,string>`` column from a small fixed dictionary."""
    items = entries.items() if isinstance(entries, Mapping) else entries
    flat = []
    for k, v in items:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def decode_array(arr, dictionary: Column) -> Column:
    """ids -> names, sorted by name, joined with ', '; NULL for a NULL/empty list."""
    a = F.col(arr) if isinstance(arr, str) else arr
    names = F.array_sort(F.transform(a, lambda i: F.try_element_at(dictionary, i)))
    return F.when(a.isNotNull() & (F.size(a) > 0), F.array_join(names, ", "))


def decode_list(df: DataFrame, keys, list_col: str, dictionary, dict_id: str = "topping_id",
                dict_name: str = "topping_name", out: str = "names", parsed: bool = True) -> DataFrame:
    """Replace a list of ids by readable text ordered by name.

    ``dictionary`` as a literal mapping (small, fixed) -> a map lookup inside the
    projection, no shuffle at all. As a DataFrame (may be large) -> explode, join,
    then ``listagg ... WITHIN GROUP (ORDER BY name)`` per ``keys`` (one shuffle on the
    keys; the join strategy is left to Spark/AQE).
    """
    keys = as_list(keys)
    arr = F.col(list_col) if parsed else split_list(list_col)
    if not isinstance(dictionary, DataFrame):
        return df.select(*keys, decode_array(arr, dictionary_map(dictionary)).alias(out))
    ex = df.select(*keys, F.explode(arr).alias(dict_id))
    j = ex.join(dictionary.select(dict_id, dict_name), dict_id)
    return j.groupBy(*keys).agg(
        F.expr(f"listagg({dict_name}, ', ') WITHIN GROUP (ORDER BY {dict_name})").alias(out))


def line_label(name_col, parts: Sequence[tuple[str, Column]]) -> Column:
    """'Name - Exclude a, b - Extra c' from (caption, text) pairs; NULL texts are
    left out."""
    pieces = [F.col(name_col) if isinstance(name_col, str) else name_col]
    for caption, text in parts:
        pieces.append(F.coalesce(F.concat(F.lit(f" - {caption} "), text), F.lit("")))
    return F.concat(*pieces)


# ---------------------------------------------------------------- O15

def with_row_id(df: DataFrame, partition: str, order_cols: Sequence[str] | None = None,
                name: str = "line_id", split_prefix: int = 0) -> DataFrame:
    """Stable line number within ``partition`` (e.g. order_id), ordered by all other
    columns. Recomputing gives the same ids (rows that tie on every column are
    identical, so swapping them changes nothing), and the numbering is parallel by
    key instead of the single-partition global ``ROW_NUMBER() OVER (ORDER BY ...)``.

    ``split_prefix=n`` protects against one huge partition: rows are numbered inside
    (partition, first n order columns) groups and shifted by the row count of the
    earlier groups, taken from a per-group count (a partial-aggregated summary whose
    window has one row per group).
    """
    order_cols = list(order_cols) if order_cols is not None else [c for c in df.columns if c != partition]
    if split_prefix <= 0:
        w = Window.partitionBy(partition).orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
        return df.withColumn(name, F.row_number().over(w))
    head, tail = order_cols[:split_prefix], order_cols[split_prefix:]
    # one struct key per group: a NULL-safe equi-join key (struct equality treats
    # NULL fields as equal) and the window's partition key, so the join and the
    # window share one hash partitioning
    t = df.withColumn("_g", F.struct(partition, *head))
    counts = t.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    wg = (Window.partitionBy(F.col("_g")[partition])
          .orderBy(*[F.col("_g")[c].asc_nulls_first() for c in head])
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_g", F.coalesce(F.sum("_n").over(wg), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_g").orderBy(*[F.col(c).asc_nulls_first() for c in tail])
    return (t.join(offsets, "_g")
             .withColumn(name, (F.row_number().over(w) + F.col("_off")).cast("int"))
             .drop("_g", "_off"))
