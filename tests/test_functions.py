from datetime import date

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillmetrics.functions import dates, names, num
from tillmetrics.functions.flags import discount_flag
from tillmetrics.operators.exact import exact_agg, mean, total


def test_rounding_ties(spark):
    values = [0.145, 0.285, 1.005, 2.675, -0.145, 0.5, -0.5, 0.49999999999999994, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(num.rounded(F.col("x"), 2)).collect()]
    # scaled in double arithmetic first, then ties away from zero
    want = [None if v is None else (1 if v > 0 else -1) * int(abs(v) * 100 + 0.5) / 100 for v in values]
    assert got == want
    whole = [r[0] for r in df.select(num.half_away(F.col("x"))).collect()]
    assert whole[5:8] == [1.0, -1.0, 0.0]
    sql = [r[0] for r in df.selectExpr(num.half_away_sql("x")).collect()]
    assert sql == whole


@pytest.mark.parametrize(
    "text, marketplace, webshop",
    [
        ("€ 1,234.50", 1234.5, 1234.5),
        ("12,50", 1250.0, 1250.0),
        ("-", None, 0.0),
        ("1.2.3", None, 0.0),
        ("", None, 0.0),
        ("0", None, 0.0),
        (None, None, 0.0),
        ("-3.5 EUR", -3.5, -3.5),
    ],
)
def test_clean_number(spark, text, marketplace, webshop):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(num.clean_number(F.col("t"), True), num.clean_number(F.col("t"), False)).first()
    assert tuple(row) == (marketplace, webshop)


def test_conversion_rate(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (0, 4), (7, -1)], "o int, v int")
    got = [str(r[0]) for r in df.select(num.conversion_rate(F.col("o"), F.col("v"))).collect()]
    assert got == ["33.3333", "0.0000", "0.0000", "0.0000"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30))
def test_exact_sum_of_cents(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(3)
    row = exact_agg(df, [], {}, {"s": total("x"), "a": mean("x", None)}).first()
    assert row.s == sum(cents) / 100
    assert row.a == sum(cents) / 100 / len(cents)


def test_exact_agg_null_groups_and_no_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.5), ("b", None)], "k string, x double")
    got = {r.k: (r.n, r.s, r.a) for r in exact_agg(df, ["k"], {"n": "count(1)"}, {"s": total("x"), "a": mean("x")}).collect()}
    assert got == {"a": (2, 1.5, 1.5), "b": (1, None, None)}
    assert tuple(exact_agg(df.filter("false"), [], {}, {"s": total("x")}).first()) == (None,)


def test_exact_sum_of_large_money(spark):
    # more than a double can add exactly one by one
    df = spark.range(100_000).selectExpr("123456789.01D as x")
    assert exact_agg(df, [], {}, {"s": total("x")}).first().s == 12345678901000.0


@pytest.mark.parametrize(
    "day, label, legacy",
    [
        ("2024-01-01", "W01-2024", "W01-2024"),
        ("2024-12-30", "W01-2025", "W01-2024"),
        ("2025-12-31", "W01-2026", "W01-2025"),
        ("2026-03-10", "W11-2026", "W11-2026"),
    ],
)
def test_week_label(spark, day, label, legacy):
    d = F.lit(day).cast("date")
    assert tuple(spark.range(1).select(dates.week_label(d), dates.week_label(d, True)).first()) == (label, legacy)


def test_dates(spark):
    d = F.lit("2026-01-21").cast("date")
    row = spark.range(1).select(
        dates.range_label(dates.week_start(d), dates.week_end(d)),
        dates.last_week(d)[0],
        dates.last_week(d)[1],
        dates.parse_day(F.lit("2026-01-05")),
        dates.parse_day(F.lit("01-05-2026")),
        dates.parse_day(F.lit("5/1/2026")),
        dates.iso_day(F.lit("2026-03-10T00:30:00+01:00")),
        dates.iso_day(F.lit("today")),
    ).first()
    assert tuple(row) == (
        "January 19-January 25, 2026", date(2026, 1, 12), date(2026, 1, 18), date(2026, 1, 5),
        date(2026, 1, 5), None, date(2026, 3, 10), None,
    )


def test_periods(spark):
    d = F.lit("2024-02-29").cast("date")
    got = spark.range(1).select(F.inline(dates.period_array("both", d))).collect()
    assert [tuple(r) for r in got] == [
        ("WEEK", "W09-2024", date(2024, 2, 26), date(2024, 3, 3)),
        ("MONTH", "2024-02", date(2024, 2, 1), date(2024, 2, 29)),
    ]
    assert len(spark.range(1).select(F.inline(dates.period_array("weekly", d))).collect()) == 1
    december = F.lit("2025-12-31").cast("date")
    month = spark.range(1).select(F.inline(dates.period_array("monthly", december))).first()
    assert tuple(month) == ("MONTH", "2025-12", date(2025, 12, 1), date(2025, 12, 31))


def test_local_today_is_a_date(spark):
    assert isinstance(spark.range(1).select(dates.local_today()).first()[0], date)


def test_names():
    assert names.plain_header(" Original_Price ") == "originalprice"
    assert names.token("  Units Sold (NL)! ") == "units_sold_nl"
    assert names.pick(["Margin%", "Total Revenue"], ["revenue", "total_revenue"]) == "Total Revenue"
    assert names.pick(["a"], ["b"]) is None
    assert names.collisions(["Margin", "Margin%", "Profit"]) == {"margin": ["Margin", "Margin%"]}


@pytest.mark.parametrize(
    "raw, flag",
    [("Yes", True), (" y ", True), ("TRUE", True), ("1", True), ("with_discount", True), ("0", False),
     ("12.5", True), ("-2", False), ("No", False), ("", False), (None, False)],
)
def test_discount_flag(spark, raw, flag):
    df = spark.createDataFrame([(raw,)], "r string")
    assert df.select(discount_flag(F.col("r"))).first()[0] is flag


def test_exact_sum_of_huge_values(spark):
    # values that are totals themselves; one beyond the room fails instead of being wrong
    df = spark.createDataFrame([(5e12 + 0.25,), (-1e12,), (3e12 + 0.5,)], "x double")
    row = exact_agg(df, [], {}, {"s": total("x"), "a": mean("x", None)}).first()
    assert (row.s, row.a) == (7000000000000.75, 7000000000000.75 / 3)
    with pytest.raises(Exception, match="OVERFLOW"):
        exact_agg(spark.range(1).selectExpr("1e16D as x"), [], {}, {"s": total("x")}).collect()


def test_exact_sum_of_negative_fractions(spark):
    df = spark.createDataFrame([(-0.1,), (-0.2,), (0.3,), (-1.005,)], "x double")
    assert exact_agg(df, [], {}, {"s": total("x", None)}).first().s == -1.005
