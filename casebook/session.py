"""Session construction with the settings every operator assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "casebook",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session configured for the library.

    * ANSI mode on (bad casts fail loudly; the operators use ``try_cast`` where a
      value may legitimately be dirty).
    * AQE on: runtime partition coalescing, skew-join splitting and the runtime
      broadcast decision (the only broadcasts of data-derived tables we allow are the
      ones AQE makes from measured shuffle sizes).
    * UTC session time zone so dates derived from timestamps do not move.
    * Spark UI off (no server is needed for batch runs).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``SparkContext.getCheckpointDir`` / ``spark.checkpoint.dir``).
    Only when nothing is configured do we pick one ourselves: ``fallback`` when given
    (tests), else a temporary folder, and that only in local mode. On a cluster a
    machine-local folder would not survive the loss of an executor, so there it is
    an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if fallback is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: configure a shared folder (e.g. on HDFS/S3) for the cluster")
    path = fallback or tempfile.mkdtemp(prefix="casebook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
