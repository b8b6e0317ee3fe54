"""Tables that Spark builds once and many queries read.

``shared`` keeps one built table for each version of its source files; ``save_bucketed``
lays a fact table out by its join key, so that joins on it need no exchange;
``replace_partitions`` puts new partitions in the place of old ones and leaves the rest.
All live in the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.session import checkpoint_dir

_BUILT: dict[tuple[str, str, str], DataFrame] = {}


def version(spark: SparkSession, paths: Sequence[str]) -> str:
    """Changes when a file under one of ``paths`` is added, removed or written anew."""
    seen = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            seen.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]


def shared(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[str], DataFrame]) -> DataFrame:
    """The table ``name`` derived from the files ``sources``: built by ``build(place)``,
    which writes it and returns it, once in a session, and again when a file changes."""
    key = (spark.sparkContext.applicationId, name, version(spark, sources))
    if key not in _BUILT:
        place = f"{checkpoint_dir(spark).rstrip('/')}/casebook-shared/{name}-{key[2]}-{uuid.uuid4().hex[:8]}"
        _BUILT[key] = build(place)
    return _BUILT[key]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], sort_within: Sequence[str] = (), files: int = 8) -> None:
    """Write ``df`` under ``path`` in place of the partitions it has rows of; others stay.

    Each partition gets at most ``files`` files, its rows dealt by hash, so one large
    partition is several tasks' work; rows are sorted within the files."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in (sort_within or df.columns)]), F.lit(files))
    out = df.withColumn("_file", spread).repartition(*partition_by, "_file").drop("_file")
    if sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, name: str, place: str, key: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """``df`` as the catalog table ``name``, hashed into ``buckets`` by ``key`` and sorted
    within them. Two tables of one key and number of buckets join without an exchange.
    For inputs of many terabytes give a bucket about the bytes of a task."""
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", place).bucketBy(buckets, key).sortBy(*(sort or [key]))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
