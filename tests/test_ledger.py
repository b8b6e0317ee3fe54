"""Balances, gap filling, percentiles, growth and allocation rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook.operators import ledger as LE
from conftest import rows, SF_SMALL
from casebook.sources import adapters as A

D = dt.date


@pytest.fixture(scope="module")
def txns(spark):
    return spark.createDataFrame([
        (1, D(2020, 1, 2), "deposit", Decimal("100")), (1, D(2020, 1, 2), "purchase", Decimal("30")),
        (1, D(2020, 1, 5), "withdrawal", Decimal("100")), (1, D(2020, 1, 7), "deposit", Decimal("50")),
        (1, D(2020, 2, 1), "other", Decimal("999")),
        (2, D(2020, 1, 6), "deposit", Decimal("10")), (2, D(2020, 1, 9), "deposit", Decimal("5")),
        (3, D(2020, 1, 10), "deposit", Decimal("1")),  # first transaction after the end: no rows
    ], "customer_id int, txn_date date, txn_type string, txn_amount decimal(12,2)")


def test_daily_balances_forward_fill(txns):
    daily = LE.daily_balances(txns, "customer_id", "txn_date", "txn_type", "txn_amount", "2020-01-08")
    got = rows(daily, "customer_id", "bal_date", "balance")
    c1 = [(d.day, b) for c, d, b in got if c == 1]
    assert c1 == [(2, 70), (3, 70), (4, 70), (5, -30), (6, -30), (7, 20), (8, 20)]
    assert [(d.day, b) for c, d, b in got if c == 2] == [(6, 10), (7, 10), (8, 10)]
    assert not [r for r in got if r[0] == 3]


def test_daily_balances_brute_force(spark):
    """Densified rows = sum over customers of (end - first + 1) days; the last balance
    of every customer equals the sum of its signed amounts."""
    t = A.event_transactions(spark, SF_SMALL)
    end = "2024-01-31"
    daily = LE.daily_balances(t, "customer_id", "txn_date", "txn_type", "txn_amount", end)
    pdf = t.toPandas()
    pdf = pdf[pdf.txn_date <= D(2024, 1, 31)]
    sign = pdf.txn_type.map({"deposit": 1, "purchase": -1, "withdrawal": -1}).fillna(0)
    pdf["signed"] = pdf.txn_amount.astype(float) * sign
    first = pdf.groupby("customer_id").txn_date.min()
    expect_rows = sum((D(2024, 1, 31) - d).days + 1 for d in first)
    assert daily.count() == expect_rows
    last = {r.customer_id: float(r.balance) for r in daily.filter(F.col("bal_date") == F.lit(end).cast("date")).collect()}
    totals = pdf.groupby("customer_id").signed.sum()
    for cid, v in totals.items():
        assert last[cid] == pytest.approx(v, abs=1e-6)


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([("r", D(2020, 1, 1), D(2020, 1, 11)), ("r", D(2020, 1, 1), D(2020, 1, 21)),
                                ("r", D(2020, 1, 1), D(2020, 1, 31)), ("r", D(2020, 1, 1), D(9999, 12, 31)),
                                ("s", D(2020, 1, 1), D(2020, 1, 1))], "g string, s date, e date")
    out = {r.g: r for r in LE.interval_stats(df, "s", "e", by="g").collect()}
    assert out["r"].p80_days == pytest.approx(26.0)
    assert out["r"].p50_days == pytest.approx(20.0)
    assert out["r"].avg_days == pytest.approx(20.0)
    assert out["s"].p95_days == 0.0  # zero-length interval
    incl = {r.g: r for r in LE.interval_stats(df, "s", "e", by="g", include_open=True).collect()}
    assert incl["r"].avg_days > 100000


def test_growth_sign_and_zero_base(spark):
    bal = spark.createDataFrame([
        (1, "2020-01", Decimal("100")), (1, "2020-02", Decimal("106")),   # +6 %
        (2, "2020-01", Decimal("100")), (2, "2020-02", Decimal("105")),   # exactly 5 %: not more
        (3, "2020-01", Decimal("-100")), (3, "2020-02", Decimal("-90")),  # a debt 10 % smaller: grew
        (5, "2020-01", Decimal("-100")), (5, "2020-02", Decimal("-200")),  # a debt twice as deep: did not
        (4, "2020-01", Decimal("0")), (4, "2020-02", Decimal("50")),      # zero base never counts
    ], "customer_id int, month string, balance decimal(18,2)")
    out = {r.month: r for r in LE.growth_over_threshold(bal, "customer_id", "month").collect()}
    assert (out["2020-02"].n_grew, out["2020-02"].n_customers) == (2, 5)
    assert out["2020-01"].n_grew == 0


def test_growth_out_of_those_with_a_month_before(spark):
    bal = spark.createDataFrame([
        (1, "2020-01", Decimal("100")), (1, "2020-03", Decimal("200")),  # silent in February
        (2, "2020-02", Decimal("10")), (2, "2020-03", Decimal("10")),
    ], "customer_id int, month string, balance decimal(18,2)")
    filled = LE.densify_months(bal, "customer_id", "month", "balance")
    got = rows(LE.growth_over_threshold(filled, "customer_id", "month", base="previous"), "month", "n_grew", "n_customers", "pct_grew")
    assert got == [("2020-01", 0, 0, None), ("2020-02", 0, 1, 0.0), ("2020-03", 1, 2, 50.0)]


def test_transaction_balances_split_and_unsplit_agree(spark, txns):
    args = ("customer_id", "txn_date", "txn_type", "txn_amount")
    whole = LE.transaction_balances(txns, *args)
    split = LE.transaction_balances(txns, *args, bucket=F.trunc("txn_date", "month"))
    cols = ("customer_id", "txn_date", "txn_type", "txn_amount", "impact", "balance")
    assert rows(whole, *cols) == rows(split, *cols)
    first = LE.balance_range(whole, "customer_id").filter("customer_id = 1").first()
    assert (first.min_balance, first.max_balance) == (Decimal("-30.00"), Decimal("100.00"))


def test_allocations_by_month(spark):
    daily = spark.createDataFrame([
        (1, D(2020, 1, 30), Decimal("10")), (1, D(2020, 1, 31), Decimal("20")), (1, D(2020, 2, 1), Decimal("-5")),
        (2, D(2020, 1, 31), Decimal("7")), (2, D(2020, 2, 1), Decimal("8")),
    ], "customer_id int, bal_date date, balance decimal(18,2)")
    assert rows(LE.allocation_period_end(daily, months_later=1), "month", "data_required") == [
        ("2020-02", Decimal("27.00")), ("2020-03", Decimal("8.00"))]
    assert rows(LE.allocation_daily(daily, monthly=True), "month", "daily_min", "daily_avg", "daily_max") == [
        ("2020-01", Decimal("10.00"), 18.5, Decimal("27.00")), ("2020-02", Decimal("8.00"), 8.0, Decimal("8.00"))]


def test_allocations(spark, txns):
    daily = LE.daily_balances(txns, "customer_id", "txn_date", "txn_type", "txn_amount", "2020-01-08")
    me = rows(LE.allocation_period_end(daily), "month", "data_required")
    assert me == [("2020-01", Decimal("30.00"))]  # 20 + 10
    rt = LE.allocation_daily(daily).collect()[0]
    # per-day positive totals: 70,70,70,0(no row: -30 only),10+? -> days 2..8
    assert rt.daily_max == Decimal("70.00")
    tr = LE.allocation_trailing(daily, rows=30).collect()[0]
    assert tr.daily_max == Decimal("70.00")
    ramp = spark.createDataFrame([(1, D(2020, 3, 1) + dt.timedelta(days=i), Decimal(i + 1)) for i in range(40)], "customer_id int, bal_date date, balance decimal(18,2)")
    assert LE.allocation_trailing(ramp, rows=30).first().daily_max == Decimal("25.50")  # mean of 11..40
    acc = LE.accrue(daily, "balance", 0.06, 365, digits=None).filter("customer_id = 1 AND bal_date = '2020-01-02'").collect()[0]
    assert acc.data_allocation == pytest.approx(70 * (1 + 0.06 / 365))


def test_daily_balances_default_end_keeps_every_transaction(txns):
    """end=None: history runs to the last day of the month of the latest
    transaction, so no row is cut off."""
    daily = LE.daily_balances(txns, "customer_id", "txn_date", "txn_type", "txn_amount")
    last = daily.agg(F.max("bal_date")).collect()[0][0]
    assert last == D(2020, 2, 29)
    c3 = rows(daily.filter("customer_id = 3"), "bal_date", "balance")
    assert c3[0] == (D(2020, 1, 10), Decimal("1.00")) and len(c3) == 51


def test_running_balance_split_equals_plain(spark):
    """Two-level prefix sum (per-month openings + per-(customer, month) windows)
    equals the single window, on raw transaction rows with a hot customer."""
    from casebook.operators.ledger import signed_amount
    t = A.customer_transactions(spark, SF_SMALL)
    hot = t.withColumn("customer_id", F.lit(-1).cast("bigint"))
    # rows tying on every order column are identical, so the multiset of
    # (row, balance) pairs does not depend on how such ties are ordered
    raw = t.unionByName(hot).withColumn("net", signed_amount("txn_type", "txn_amount"))
    plain = LE.running_balance(raw, "customer_id", ["txn_date", "txn_type", "txn_amount"], "net")
    split = LE.running_balance(raw, "customer_id", ["txn_date", "txn_type", "txn_amount"], "net",
                               bucket=F.trunc("txn_date", "month"))
    cols = ["customer_id", "txn_date", "txn_type", "txn_amount", "balance"]
    assert rows(plain, *cols) == rows(split, *cols)


def test_percentile_approx_option(spark):
    df = spark.range(1, 1001).select(F.lit("g").alias("g"), F.lit(D(2020, 1, 1)).alias("s"),
                                     F.date_add(F.lit(D(2020, 1, 1)), F.col("id").cast("int")).alias("e"))
    ex = LE.interval_stats(df, "s", "e", by="g").collect()[0]
    ap = LE.interval_stats(df, "s", "e", by="g", exact=False).collect()[0]
    assert ex.p50_days == pytest.approx(500.5)
    assert abs(ap.p50_days - ex.p50_days) <= 1 and abs(ap.p95_days - ex.p95_days) <= 1


def test_running_balance_split_spreads_hot_customer(spark):
    n = 20000
    # a computed (not literal) key, and no broadcasts: as with real data at scale
    hot = spark.range(n).select((F.col("id") * 0 + 1).alias("customer_id"),
                                F.date_add(F.lit(D(2015, 1, 1)), (F.col("id") / 3).cast("int")).alias("d"),
                                F.col("id").alias("seq"), F.lit(Decimal("1.00")).alias("net"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = LE.running_balance(hot, "customer_id", ["d", "seq"], "net", bucket=F.trunc("d", "month"))
        parts = split.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.max("balance")).collect()
        assert len(parts) >= 4
        assert split.agg(F.max("balance")).collect()[0][0] == Decimal(n)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_densify_months(spark):
    bal = spark.createDataFrame([(1, "2020-01", Decimal("5")), (1, "2020-03", Decimal("7")), (2, "2020-04", Decimal("1"))],
                                "customer_id int, month string, balance decimal(18,2)")
    got = rows(LE.densify_months(bal, "customer_id", "month", "balance"))
    assert got == [(1, "2020-01", Decimal("5.00")), (1, "2020-02", Decimal("5.00")), (1, "2020-03", Decimal("7.00")),
                   (1, "2020-04", Decimal("7.00")), (2, "2020-04", Decimal("1.00"))]
