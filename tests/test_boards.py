from datetime import date

import pytest
from pyspark.sql import functions as F

from tillmetrics.operators.ranking import latest_rows, page
from tillmetrics.plans import conversion, conversion_board as board, kpis, reports, sales_view, unified

METRICS = (
    "offer_id string, product_name string, date date, period_type string, period_label string, "
    "visits_nl int, visits_be int, visits_total int, orders int, conversion_rate double"
)


def metric(offer, name, week, nl, be, orders):
    return (offer, name, date(2025, 12, 21 + 7 * week) if week < 2 else date(2026, 1, 7 * week - 10), "WEEK", f"W{week}", nl, be, nl + be, orders, 0.0)


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame(
        [
            metric("o1", "Lamp", 0, 10, 10, 2),
            metric("o2", "Lamp", 0, 30, 0, 3),
            metric("o3", "Chair", 0, 0, 5, 5),
            metric("o1", "Lamp", 2, 10, 0, 1),
            metric("o4", "Desk", 2, 0, 10, 1),
        ],
        METRICS,
    )


def test_trend_adds_offers_of_a_product_and_fills_gaps(metrics, rows):
    got = rows(board.trend(metrics), "product_name", "period_label", "conversion")
    assert got == [
        ("Chair", "W0", 100.0), ("Chair", "W2", 0.0), ("Desk", "W0", 0.0), ("Desk", "W2", 10.0),
        ("Lamp", "W0", 10.0), ("Lamp", "W2", 10.0),
    ]
    assert {r[0] for r in rows(board.trend(metrics, top=2), "product_name")} == {"Desk", "Lamp"}
    nl = dict((r[0] + r[1], r[2]) for r in rows(board.trend(metrics, "NL"), "product_name", "period_label", "conversion"))
    assert nl["LampW0"] == 12.5 and nl["DeskW2"] == 0.0


def test_kpis_of_a_selection(metrics, spark):
    chosen = board.selected_metrics(metrics, "WEEK", "W0", " LAMP", "NL")
    assert tuple(board.kpis(chosen).first()) == (5, 40, 12.5, "Lamp", 20.0)
    nothing = board.selected_metrics(metrics, "MONTH")
    assert tuple(board.kpis(nothing).first()) == (0, 0, 0.0, "-", None)
    by_id = board.selected_metrics(metrics, "WEEK", text="O4")
    assert by_id.count() == 1


def test_periods_newest_first_across_years(metrics):
    assert [r.period_label for r in board.periods(metrics, "WEEK").collect()] == ["W2", "W0"]


def test_newest_metric_row(spark):
    df = spark.createDataFrame(
        [("o", "WEEK", "W1", date(2026, 1, 4), 1, "a"), ("o", "WEEK", "W1", date(2026, 1, 4), 2, "b"), ("o", "WEEK", "W1", date(2026, 1, 3), 3, "c")],
        "offer_id string, period_type string, period_label string, date date, seq int, x string",
    )
    assert [r.x for r in board.newest_metrics(df, "seq").collect()] == ["b"]


def test_conversion_rows_from_text(spark):
    df = spark.createDataFrame(
        [("1", "", None, "2026-01-04", "WEEK", "W1", "3", "", "x", None, "1.5")],
        "offer_id string, product_name string, ean string, date string, period_type string, period_label string, "
        "visits_nl string, visits_be string, visits_total string, orders string, conversion_rate string",
    )
    row = board.normalize_rows(df).first()
    assert (row.product_name, row.ean, row.visits_nl, row.visits_be, row.visits_total, row.orders, row.conversion_rate) == (
        "Unknown", "", 3, 0, 0, 0, 1.5,
    )


def test_offers_without_orders_and_shared_eans(spark, rows):
    offers = spark.createDataFrame([("a", "1", "T"), ("b", "1", ""), ("c", "2", None), (None, "1", "x"), ("d", None, None)], "offer_id string, ean string, product_title string")
    orders = spark.createDataFrame(
        [("1", "2026-01-05T23:30:00+01:00", 2), ("1", "2026-01-11", 1), ("1", "2026-01-12", 9), ("1", "bad", 9), (None, "2026-01-05", 9)],
        "ean string, order_placed_at string, quantity int",
    )
    got = rows(conversion.units_by_offer(offers, orders, "2026-01-05", "2026-01-11"))
    assert got == [("a", 3), ("b", 3), ("c", 0), ("d", 0)]
    got = rows(conversion.daily_units_by_offer(offers, orders, "2026-01-05", "2026-01-11"))
    first, last = date(2026, 1, 5), date(2026, 1, 11)
    assert set(got) == {("a", first, 2), ("a", last, 1), ("b", first, 2), ("b", last, 1)} and len(got) == 4

    costs = spark.createDataFrame([("1", "Cost name"), ("2", "")], "ean string, product_name string")
    assert rows(conversion.offer_catalog(offers, costs)) == [
        ("a", "Cost name", "1"), ("b", "Cost name", "1"), ("c", "Unknown Product", "2"), ("d", "Unknown Product", ""),
    ]

    visits = spark.createDataFrame([("a", "WEEK", 4, 2, 6), ("c", "WEEK", 1, 1, 2)], "offer_id string, period_type string, visits_nl int, visits_be int, visits_total int")
    m = conversion.conversion_metrics(offers, costs, orders, visits, "both", "2026-01-07")
    got = {(r.offer_id, r.period_type): (r.date, r.visits_total, r.orders, str(r.conversion_rate)) for r in m.collect()}
    assert got["a", "WEEK"] == (date(2026, 1, 11), 6, 3, "50.0000")
    assert got["b", "WEEK"] == (date(2026, 1, 11), 0, 3, "0.0000")
    assert got["a", "MONTH"] == (date(2026, 1, 31), 0, 12, "0.0000")
    assert len(got) == 8

    daily = spark.createDataFrame([("a", date(2026, 1, 5), 4, 0, 4), ("a", date(2026, 1, 4), 1, 0, 1), ("z", date(2026, 1, 5), 1, 0, 1)], "offer_id string, day date, visits_nl int, visits_be int, visits_total int")
    d = conversion.conversion_daily(offers, costs, orders, daily, "weekly", "2026-01-07")
    assert rows(d, "offer_id", "date", "orders", F.col("conversion_rate").cast("string")) == [("a", date(2026, 1, 5), 2, "50.0000")]


@pytest.fixture
def sales(spark):
    return sales_view.normalized_sales(
        spark.createDataFrame(
            [
                ("B", 5.0, 100.0, 2.0, "2026-01-05", "yes"),
                ("A", 5.0, 50.0, 2.0, "2026-01-12", "0"),
                ("C", 0.0, 0.0, -1.0, "2026-01-13", "3"),
            ],
            "product string, units double, revenue double, net_margin_eur double, order_date string, discount string",
        )
    )


def test_leaders_break_ties_by_name(sales, spark):
    row = kpis.leaders(sales).first()
    assert (row.top_seller, row.top_seller_units, row.most_profitable, row.most_profitable_profit) == ("A", 5.0, "A", 10.0)
    row = kpis.leaders(sales.filter("product_name = 'C'")).first()
    assert (row.top_seller, row.top_seller_units, row.most_profitable) == ("-", 0.0, "C")
    assert kpis.leaders(sales.filter("false")).first().most_profitable == "-"


def test_headline(sales):
    row = kpis.headline(sales).first()
    assert (row.total_units, row.total_revenue, row.week_count, row.avg_weekly_revenue, row.discount_rate) == (10.0, 150.0, 2, 75.0, 66.7)
    empty = kpis.headline(sales.filter("false")).first()
    assert (empty.total_units, empty.week_count, empty.discount_rate) == (0.0, 1, 0.0)


def test_filters_and_domains(sales, spark, rows):
    assert rows(sales_view.filtered(sales, week=3), "product_name") == [("A",), ("C",)]
    assert sales_view.filtered(sales, products=[]).count() == 3
    assert rows(sales_view.filtered(sales, start="2026-01-06", end="2026-01-12"), "product_name") == [("A",)]
    names = spark.createDataFrame([("A",), ("A",)], "product_name string")
    assert sales_view.filtered(sales, products=names).count() == 1
    assert rows(kpis.filter_domains(sales)) == [
        ("max_date", "2026-01-13"), ("min_date", "2026-01-05"), ("product", "A"), ("product", "B"),
        ("product", "C"), ("week", "2"), ("week", "3"),
    ]


def test_pages(spark):
    df = spark.createDataFrame([("b",), ("A",), (None,), ("C",), ("a",)], "x string")
    assert [r.x for r in page(df, "x", descending=False, size=10).collect()] == [None, "A", "a", "b", "C"]
    df = spark.range(25)
    assert [r.id for r in page(df, "id", number=3).collect()] == [4, 3, 2, 1, 0]
    assert page(df, "id", number=4).count() == 0


def test_latest_rows_put_missing_dates_last(spark):
    df = spark.createDataFrame([(None, 1), (date(2026, 1, 1), 2), (date(2026, 1, 2), 3)], "date date, n int")
    assert [r.n for r in latest_rows(df, 2).collect()] == [3, 2]


def test_report_formats(spark):
    df = spark.createDataFrame([(date(2026, 1, 5), "x", 1234567, 1234.5, None)], "order_date date, channel string, total_orders bigint, total_revenue double, avg_order_value double")
    assert tuple(reports.revenue_tab(df).first()) == ("2026-01-05", "x", "1,234,567", "€ 1,234.50", None)
    one = spark.range(1).select(reports.formatted(F.lit(12.34), "percentage"), reports.formatted(F.lit(2.25), "decimal"))
    assert one.first()[0] == "12.3%"


def test_surrogate_keys_tell_null_from_text(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x")], "a string, b string")
    keys = [r[0] for r in df.select(unified.surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 2


def test_currency(spark):
    rates = spark.createDataFrame([("USD", 0.5)], "currency string, rate double")
    df = spark.createDataFrame([(10.0, "USD"), (10.0, "EUR"), (10.0, "XXX")], "a double, c string")
    got = {r.c: r.eur for r in unified.convert_currency(df, "a", "c", rates, into="eur").collect()}
    assert got == {"USD": 5.0, "EUR": 10.0, "XXX": 10.0}
