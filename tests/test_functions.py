"""Small column helpers: text concatenation, percentages, safe division, dates."""

import datetime as dt

from casebook.functions import concat_nullsafe, month_key, pct, percent_text, safe_div, week_of_year_block


def test_concat_and_percent_text(spark):
    df = spark.createDataFrame([("a", None, 1, 8), ("b", "x", 0, 0)], "s string, t string, n int, d int")
    got = df.select(concat_nullsafe("s", "t").alias("c"), percent_text("n", "d", 1).alias("p"),
                    pct("n", "d", 1).alias("v"), safe_div("n", "d").alias("q")).collect()
    assert [tuple(r) for r in got] == [("a", "12.5%", 12.5, 0.125), ("bx", None, None, None)]


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 7),), (dt.date(2021, 1, 8),), (dt.date(2020, 1, 31),)], "d date")
    got = df.select(week_of_year_block("d").alias("w"), month_key("d").alias("m")).collect()
    assert [tuple(r) for r in got] == [(1, "2021-01"), (2, "2021-01"), (5, "2020-01")]
