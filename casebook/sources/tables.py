"""Readers for the driver's Parquet tables (one file or folder per table under ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebook.sources.io import load_table

# Declared columns of the business tables. Reading them needs no footer while a plan is
# built; Parquet gives what is not in the declaration to nobody.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
# Tables of texts and vectors, whose columns are their operators' business: read as they are.
TABLES = (*SCHEMAS, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``, with its declared columns where there are any;
    when ``columns`` are given only those are selected, so the scan's ReadSchema is
    pruned even before Catalyst sees the rest of the plan."""
    path = table_path(sf_dir, name)
    df = load_table(spark, path, SCHEMAS[name]) if name in SCHEMAS else spark.read.parquet(path)
    return df.select(*columns) if columns else df
