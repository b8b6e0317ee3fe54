"""Recurring dates (sticky month ends, first date always emitted) and the ledger."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from casebook.operators import billing as BI
from casebook.sources.adapters import plans
from conftest import rows

D = dt.date


def _dates(spark, start, end, step):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    return df.select(BI.payment_dates("s", "e", step).alias("d")).collect()[0].d


def test_sticky_month_end(spark):
    assert _dates(spark, D(2020, 1, 31), D(2020, 5, 1), 1) == [D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 29), D(2020, 4, 29)]
    assert _dates(spark, D(2020, 4, 30), D(2020, 7, 30), 1) == [D(2020, 4, 30), D(2020, 5, 30), D(2020, 6, 30)]


def test_yearly_and_strict_end(spark):
    assert _dates(spark, D(2020, 2, 29), D(2023, 2, 28), 12) == [D(2020, 2, 29), D(2021, 2, 28), D(2022, 2, 28)]
    assert _dates(spark, D(2020, 1, 1), D(2020, 3, 1), 1) == [D(2020, 1, 1), D(2020, 2, 1)]


def test_first_date_always_emitted(spark):
    assert _dates(spark, D(2021, 4, 30), D(2021, 4, 30), 1) == [D(2021, 4, 30)]
    assert _dates(spark, D(2021, 5, 3), D(2021, 4, 30), 1) == [D(2021, 5, 3)]
    assert _dates(spark, D(2021, 5, 3), None, 1) == [D(2021, 5, 3)]


def test_ledger_rules(spark):
    subs = spark.createDataFrame([
        # trial -> basic -> pro monthly (upgrade credit) -> churn
        (1, 0, D(2020, 1, 1), 1), (1, 1, D(2020, 1, 8), 2), (1, 2, D(2020, 3, 20), 3), (1, 4, D(2020, 5, 1), 4),
        # trial -> annual, no further change: yearly until the horizon
        (2, 0, D(2020, 1, 1), 5), (2, 3, D(2020, 1, 8), 6),
        # basic -> annual (credit on the first annual payment only)
        (3, 1, D(2020, 1, 31), 7), (3, 3, D(2020, 3, 15), 8),
        # only trial
        (4, 0, D(2020, 6, 1), 9),
    ], "customer_id bigint, plan_id int, start_date date, sub_seq bigint")
    out = BI.billing_ledger(subs, plans(spark), "2021-12-31")
    got = rows(out, "customer_id", "plan_id", "payment_date", "amount_paid")
    c1 = [r for r in got if r[0] == 1]
    assert c1 == [(1, 1, D(2020, 1, 8), Decimal("9.90")), (1, 1, D(2020, 2, 8), Decimal("9.90")),
                  (1, 1, D(2020, 3, 8), Decimal("9.90")), (1, 2, D(2020, 3, 20), Decimal("10.00")),
                  (1, 2, D(2020, 4, 20), Decimal("19.90"))]
    assert [r for r in got if r[0] == 2] == [(2, 3, D(2020, 1, 8), Decimal("199.00")), (2, 3, D(2021, 1, 8), Decimal("199.00"))]
    c3 = [r for r in got if r[0] == 3]
    assert c3 == [(3, 1, D(2020, 1, 31), Decimal("9.90")), (3, 1, D(2020, 2, 29), Decimal("9.90")),
                  (3, 3, D(2020, 3, 15), Decimal("189.10")), (3, 3, D(2021, 3, 15), Decimal("199.00"))]
    assert not [r for r in got if r[0] == 4]


def _add_months_clamped(d, months):
    import calendar
    y, m = divmod(d.month - 1 + months, 12)
    y, m = d.year + y, m + 1
    return D(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def test_payment_dates_brute_force(spark):
    """200 random (start, end, step) cases against a plain Python loop."""
    import random
    rnd = random.Random(7)
    cases = []
    for _ in range(200):
        s = D(2019, 1, 1) + dt.timedelta(days=rnd.randrange(0, 900))
        e = s + dt.timedelta(days=rnd.randrange(-40, 1200)) if rnd.random() > 0.05 else None
        step = rnd.choice([1, 1, 3, 12])
        cases.append((s, e, step))
    df = spark.createDataFrame(cases, "s date, e date, step int")
    got = [r.d for r in df.select(BI.payment_dates("s", "e", F.col("step")).alias("d")).collect()]
    for (s, e, step), g in zip(cases, got):
        want = [s]
        while e is not None:
            nxt = _add_months_clamped(want[-1], step)
            if nxt >= e:
                break
            want.append(nxt)
        assert g == want, (s, e, step)
