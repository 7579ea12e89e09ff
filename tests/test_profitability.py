from datetime import datetime

import pytest

from tillmetrics.plans import profitability, rollups, staging
from tillmetrics.session import scratch_path

ORDERS = (
    "order_id string, order_item_id string, order_placed_at string, title string, ean string, "
    "quantity int, unit_price double, total_price double, commission double"
)
OFFERS = "offer_id string, ean string, unit_price double"
COSTS = "ean string, original_price double, cogs double, estimated_ad_cost double"


def line(item, ean="1", quantity=1, price=12.1, commission=1.0, placed="2026-03-10T00:30:00+01:00"):
    return ("o", item, placed, "P", ean, quantity, price, price, commission)


@pytest.fixture
def lines(spark):
    def run(orders, offers=(), costs=(), **options):
        return profitability.marketplace_profitability(
            staging.marketplace_orders(spark.createDataFrame(list(orders), ORDERS)),
            spark.createDataFrame(list(offers), OFFERS),
            spark.createDataFrame(list(costs), COSTS),
            **options,
        )

    return run


def test_formulas(lines):
    row = lines([line("i", quantity=3)], [("f", "1", 20.0)], [("1", 24.2, 2.0, 0.5)]).first()
    assert row.net_selling_price == 10.0
    assert row.original_price == 24.2
    assert row.discount_used_pct == 50.0
    assert row.net_margin_eur == 6.5
    assert row.net_margin_pct == 65.0
    assert row.revenue == pytest.approx(36.3)
    assert row.profit == 19.5
    assert row.cogs_total == 6.0


def test_listed_price_zero_falls_back_to_the_offer(lines):
    row = lines([line("i")], [("f", "1", 20.0)], [("1", 0.0, 2.0, 0.5)]).first()
    assert row.original_price == 20.0
    row = lines([line("i")], [("f", "1", 20.0)], [("1", None, 2.0, 0.5)]).first()
    assert row.original_price == 20.0


def test_no_offer_no_cost(lines):
    row = lines([line("i")]).first()
    assert (row.original_price, row.cogs, row.discount_used_pct, row.net_margin_eur) == (None, 0.0, 0.0, 9.0)


def test_null_commission_makes_margin_and_profit_null(lines):
    row = lines([line("i", commission=None)]).first()
    assert (row.net_margin_eur, row.net_margin_pct, row.profit) == (None, None, None)
    assert row.revenue == 12.1
    row = lines([line("i", commission=None)], after_commission=False).first()
    assert row.net_margin_eur == 10.0


def test_staging_drops_invalid_rows_and_keeps_wall_clock(lines):
    out = lines([line("a", quantity=0), line("b", quantity=None), line("c", price=0.0), line(None), line("d")]).collect()
    assert [(r.order_item_id, r.date) for r in out] == [("d", datetime(2026, 3, 10, 0, 30))]


def test_unparsable_moment_is_null(lines):
    assert lines([line("i", placed="soon")]).first().date is None
    assert lines([line("i", placed="2026-03-10")]).first().date == datetime(2026, 3, 10)


def test_two_offers_of_one_ean(lines):
    offers = [("b", "1", 30.0), ("a", "1", 20.0)]
    assert lines([line("i")], offers).count() == 2
    assert [r.original_price for r in lines([line("i")], offers, dedupe_offers=True).collect()] == [20.0]


def webshop(spark, items, orders, costs=()):
    return profitability.webshop_profitability(
        spark.createDataFrame(
            items,
            "order_id string, line_item_id string, sku string, name string, quantity int, price double, total_discount double",
        ),
        spark.createDataFrame(orders, "order_id string, created_at timestamp_ntz, landing_site string"),
        spark.createDataFrame(
            list(costs), "sku string, product_name string, original_price double, cogs double, estimated_ad_cost double"
        ),
    )


def test_webshop_formulas(spark):
    at = datetime(2026, 3, 10)
    out = webshop(
        spark,
        [("o", "1", "s", "N", 2, 15.0, 5.8), ("x", "2", "s", "N", 1, 1.0, 0.0), ("p", "3", "s", "N", 1, 12.1, None)],
        [("o", at, "/ref"), ("p", at, None)],
        [("s", None, 0.0, 2.0, 9.0)],
    )
    got = {r.line_item_id: r for r in out.collect()}
    assert set(got) == {"1", "3"}  # an item without its order goes
    first = got["1"]
    assert first.product_name == "N"
    assert first.original_price == 0.0  # zero stays: no fallback in this channel
    assert first.selling_price == pytest.approx(12.1)
    assert first.shopify_affiliate_fee == 1.45
    assert first.net_margin_eur == 6.55  # ad cost is not subtracted
    assert first.discount_used_pct == 0.0
    third = got["3"]
    assert (third.selling_price, third.revenue, third.profit) == (None, None, None)
    assert third.shopify_affiliate_fee == 0.0


def test_weekly_rollup_adds_up_to_the_product_summary(spark, lines):
    orders = [
        line(f"i{n}", ean=str(n % 3), quantity=n % 4 + 1, price=10 + n / 7, placed=f"2025-12-{20 + n % 12:02d}")
        for n in range(60)
    ]
    detail = lines(orders)
    weekly = rollups.weekly_rollup(detail)
    summary = {r.ean: r for r in rollups.product_summary(detail).collect()}
    for r in weekly.groupBy("ean").agg({"total_units": "sum", "total_profit": "sum"}).collect():
        assert r["sum(total_units)"] == summary[r.ean].total_units
        assert r["sum(total_profit)"] == pytest.approx(summary[r.ean].total_profit)
    total = rollups.grand_total(rollups.product_summary(detail)).first()
    assert total.total_units == sum(r.total_units for r in summary.values())


def test_rollup_around_new_year(spark, lines):
    weeks = rollups.weekly_rollup(
        lines([line("a", placed="2024-12-30"), line("b", placed="2024-01-01"), line("c", placed="2025-12-31")])
    )
    got = {(str(r.week_start), str(r.week_end), r.iso_week) for r in weeks.collect()}
    assert got == {("2024-12-30", "2025-01-05", 1), ("2024-01-01", "2024-01-07", 1), ("2025-12-29", "2026-01-04", 1)}


def test_summary_does_not_depend_on_partitioning(spark, lines):
    orders = [line(f"i{n}", quantity=n % 5 + 1, price=(n * 37 % 1000) / 7 + 0.01) for n in range(400)]
    a = rollups.product_summary(lines(orders)).collect()
    b = rollups.product_summary(lines(orders[::-1]).repartition(7)).collect()
    assert a == b


def test_a_date_range_skips_files(spark):
    path = scratch_path(spark, "orders")
    moments = spark.range(8000).selectExpr(
        "string(id) as order_id", "string(id) as order_item_id",
        "concat(date_add(date '2026-01-01', cast(id / 200 as int)), 'T23:30:00+01:00') as order_placed_at",
        "string(id % 9) as ean", "1 as quantity", "2.0D as unit_price",
    )
    moments.repartitionByRange(20, "order_placed_at").write.parquet(path)
    raw = spark.read.parquet(path)
    all_rows = staging.marketplace_orders(raw).filter("date(order_placed_at) between '2026-01-10' and '2026-01-11'")
    pruned = staging.marketplace_orders(raw, "2026-01-10", "2026-01-11").filter(
        "date(order_placed_at) between '2026-01-10' and '2026-01-11'"
    )
    assert pruned.count() == all_rows.count() == 400
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    again = staging.marketplace_orders(raw, "2026-01-10", "2026-01-11")
    scan = again._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(order_placed_at,2026-01-10), LessThan(order_placed_at,2026-01-12)" in scan
