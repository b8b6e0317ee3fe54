"""O1: typed load/save, schema conformance, staged intermediate tables."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from casebook.sources.io import conform, load_table, save_table, stage_table
from conftest import rows

RATINGS = "order_id INT, rating INT"
PAYMENTS = "customer_id INT, plan_id INT, payment_date DATE, amount_paid DECIMAL(5,2)"


def test_save_conform_and_load(spark):
    out = tempfile.mkdtemp(prefix="casebook-io-")
    df = spark.createDataFrame([(1, 2, "2020-01-01", 9.9)], "customer_id bigint, plan_id bigint, payment_date string, amount_paid double")
    save_table(df, f"{out}/payments", PAYMENTS, partition_by=["plan_id"])
    back = load_table(spark, f"{out}/payments", PAYMENTS)
    assert rows(back.select("customer_id", "plan_id", "payment_date", "amount_paid")) == \
        [(1, 2, dt.date(2020, 1, 1), Decimal("9.90"))]
    # overwrite is idempotent
    save_table(df, f"{out}/payments", PAYMENTS, partition_by=["plan_id"])
    assert load_table(spark, f"{out}/payments", PAYMENTS).count() == 1


def test_conform_adds_missing_columns(spark):
    df = spark.createDataFrame([(7,)], "order_id bigint")
    c = conform(df, RATINGS)
    assert c.dtypes == [("order_id", "int"), ("rating", "int")]
    assert rows(c) == [(7, None)]


def test_csv_with_schema(spark):
    d = tempfile.mkdtemp(prefix="casebook-csv-")
    with open(os.path.join(d, "r.csv"), "w") as f:
        f.write("order_id,rating\n1,5\n2,3\n")
    assert rows(load_table(spark, d, RATINGS, fmt="csv")) == [(1, 5), (2, 3)]


def test_stage_table_reads_back(spark):
    df = spark.range(10).withColumn("m", F.col("id") % 3)
    staged = stage_table(df, "unit-stage", partition_by=["m"])
    assert staged.count() == 10
    assert "casebook-stage/unit-stage" in staged.inputFiles()[0]


def test_namespace_table_roundtrip(spark):
    """CREATE DATABASE IF NOT EXISTS, a typed catalog table written twice
    (overwrite = idempotent replace) and read back as ``db.table``."""
    from casebook.sources.io import ensure_database, save_as_table
    ensure_database(spark, "casebook_test")
    df = spark.createDataFrame([(1, 5), (2, 3)], "order_id bigint, rating bigint")
    save_as_table(df, "casebook_test.ratings", RATINGS)
    save_as_table(df, "casebook_test.ratings", RATINGS)
    t = spark.table("casebook_test.ratings").alias("r")
    assert t.dtypes == [("order_id", "int"), ("rating", "int")]
    assert rows(t) == [(1, 5), (2, 3)]


def test_checkpoint_dir_never_local_on_a_cluster():
    """No configured checkpoint folder: local mode may use a temporary folder, a
    cluster master must not (a lost executor would lose it)."""
    import pytest
    from casebook.session import checkpoint_dir

    class _SC:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Spark:
        def __init__(self, master):
            self.sparkContext, self.conf = _SC(master), _Conf()

    with pytest.raises(ValueError):
        checkpoint_dir(_Spark("yarn"))
    assert checkpoint_dir(_Spark("local[4]"))
    assert checkpoint_dir(_Spark("yarn"), fallback="hdfs:///shared/ckpt") == "hdfs:///shared/ckpt"
