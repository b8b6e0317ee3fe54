"""O1: typed batch load and idempotent save.

The source scripts declare every table up front and insert literal rows; here a
table is a set of files read with an explicit schema (never inferred), and a result
is written with ``overwrite`` after being cast to the declared target schema.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def load_table(spark: SparkSession, path: str, schema: StructType | str,
               fmt: str = "parquet", **options) -> DataFrame:
    """Read ``path`` with a fixed schema (``fmt`` = parquet, csv, json, orc).

    Parquet keeps predicate pushdown and column pruning. For CSV a header row is
    assumed unless ``header=False`` is passed.
    """
    reader = spark.read.schema(_as_struct(schema)).format(fmt)
    if fmt == "csv":
        options.setdefault("header", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, same order, each column cast to
    the declared type. A column missing from ``df`` becomes a typed NULL."""
    st = _as_struct(schema)
    cols = []
    for f in st.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def save_table(df: DataFrame, path: str, schema: StructType | str | None = None,
               fmt: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] | None = None,
               sort_within: Sequence[str] | None = None) -> None:
    """Write ``df`` (conformed to ``schema`` when given), replacing what was there.

    ``partition_by`` lays the files out by e.g. month so later readers prune; the
    optional ``sort_within`` orders rows inside each file (no global sort, so no
    single-partition exchange).
    """
    out = conform(df, schema) if schema is not None else df
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_as_table(df: DataFrame, name: str, schema: StructType | str | None = None,
                  mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    """Same as :func:`save_table` into a catalog table (``db.table``)."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def ensure_database(spark: SparkSession, name: str, use: bool = False) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (+ make it current)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    if use:
        spark.catalog.setCurrentDatabase(name)


def stage_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet in the cluster's shared checkpoint folder and
    return a DataFrame that reads it back.

    This is the reusable intermediate table of the source (a temp table read by
    several later queries). Reading it back cuts the lineage, so later jobs do not
    recompute it and a lost executor costs a re-read, not a recomputation. The folder
    comes from the session (``spark.checkpoint.dir``); see
    :func:`casebook.session.checkpoint_dir`. Each call writes to a path of its own.
    """
    from casebook.session import checkpoint_dir

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/casebook-stage/{name}-{uuid.uuid4().hex}"
    save_table(df, path, partition_by=partition_by)
    return spark.read.schema(df.schema).parquet(path)  # no footer is read while the plan is built
