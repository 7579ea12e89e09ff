"""Queries: text files written from the tables and read back."""

from __future__ import annotations

from tillmetrics.catalog.conversion import DAILY_WITH, METRICS_WITH, daily, metrics
from tillmetrics.catalog.mapping import read, table, with_tables
from tillmetrics.catalog.profit import A1, A2, A4, A4_WS, V1_WITH, V2_WITH, marketplace_lines, webshop_lines
from tillmetrics.catalog.registry import query, r
from tillmetrics.plans import conversion_board as board, rollups, sales_view
from tillmetrics.session import scratch_path
from tillmetrics.sinks import exports
from tillmetrics.sources import files

_LIST_SQL = """select cast(p_partkey as varchar) as {key}, {name} as product_name,
    {price} as original_price,
    {cogs} as cogs, {ad} as estimated_ad_cost
    from part where p_type <> 'PROMO'"""


@query(
    "s6_marketplace_cost_list",
    _LIST_SQL.format(
        key="ean", name="concat(p_name, ', ', p_brand)", price="p_retailprice",
        cogs="case when p_size > 16 then cast(p_size as double) end", ad="cast(null as double)",
    ),
)
def s6(spark, sf):
    """A tab-separated list, quoted, with blank keys, currency text, zeros and junk."""
    path = scratch_path(spark, "costs")
    rows = read(spark, sf, "part").selectExpr(
        "if(p_type = 'PROMO', ' ', string(p_partkey)) as ` EAN`",
        "concat(' ', p_name, ', ', p_brand) as `Product Name`",
        "concat('€ ', string(p_retailprice)) as Original_Price",
        "if(p_size > 16, string(p_size), '0') as COGS",
        "if(p_size > 30, '1.2.3', '-') as `estimated ad cost`",
    )
    rows.write.option("header", True).option("sep", "\t").option("quoteAll", True).csv(path)
    return files.marketplace_costs(spark, path)


@query(
    "s7_webshop_cost_list",
    _LIST_SQL.format(
        key="sku", name="p_name", price="p_retailprice",
        cogs="case when p_size > 16 then cast(p_size as double) else 0.0::double end", ad="0.0::double",
    ),
)
def s7(spark, sf):
    path = scratch_path(spark, "costs")
    rows = read(spark, sf, "part").selectExpr(
        "if(p_type = 'PROMO', null, string(p_partkey)) as SKU",
        "p_name as `Product Name`",
        "concat(string(p_retailprice), ' EUR') as `original price`",
        "if(p_size > 16, string(p_size), '') as COGS",
        "if(p_size > 30, 'n/a', '0') as `Estimated Ad Cost`",
    )
    rows.write.option("header", True).csv(path)
    return files.webshop_costs(spark, path)


def _from_summary(source: str, key: str) -> str:
    """Normalized sales of a summary whose columns carry the report labels."""
    return f"""select coalesce(product_name, '(Unknown)') as product_name, coalesce({key}, '') as ean,
        total_units::double as units_sold, coalesce(total_revenue, 0) as revenue,
        {r("total_units::double * coalesce(avg_selling_price / 1.21::double, 0)", 2)} as revenue_ex_vat,
        coalesce(avg_selling_price / 1.21::double, 0) as net_selling_price,
        coalesce(avg_selling_price, 0) as selling_price,
        coalesce(nullif(avg_original_price, 0), avg_selling_price, 0) as original_price,
        case when avg_original_price > 0 and avg_selling_price > 0
             then {r("(avg_original_price - avg_selling_price) / avg_original_price * 100", 1)}
             else coalesce(avg_discount_pct, 0) end as discount_used_pct,
        coalesce(avg_cogs, 0) as cogs, %AD% as estimated_ad_cost,
        coalesce(avg_net_margin, 0) as net_margin_eur,
        greatest(-100, least(100, coalesce(avg_margin_pct, 0))) as net_margin_pct,
        cast(latest_order as date) as order_date, %WEEK% as week_number,
        coalesce(avg_discount_pct > 0, false) as discount_applied from {source}"""


_SUMMARY = _from_summary("a1", "ean").replace("%AD%", "0.0::double").replace(
    "%WEEK%", "cast(extract(week from latest_order) as integer)"
)


@query("s8_summary_csv", f"{V1_WITH}, {A1} {_SUMMARY}")
def s8(spark, sf):
    path = scratch_path(spark, "summary.csv")
    exports.write_summary(rollups.product_summary(marketplace_lines(spark, sf)), path)
    return sales_view.normalized_sales(files.sales_csv(spark, path))


@query("s9_summary_parquet", f"{V1_WITH}, {A1} {_SUMMARY}")
def s9(spark, sf):
    path = scratch_path(spark, "summary.parquet")
    exports.summary_report(rollups.product_summary(marketplace_lines(spark, sf))).write.parquet(path)
    return sales_view.normalized_sales(files.sales_parquet(spark, path))


_WEEK_KEYS = "cast(week_start as varchar) as file_start, cast(week_end as varchar) as file_end, iso_week as file_week"


@query(
    "s10_weekly_files",
    f"""{V1_WITH}, {A4} select {_WEEK_KEYS}, ean, cast(total_units as double) as units,
    coalesce(total_revenue, 0) as revenue from a4""",
)
def s10(spark, sf):
    path = scratch_path(spark, "weekly")
    exports.write_weekly(rollups.weekly_rollup(marketplace_lines(spark, sf)), path, compression="gzip")
    rows = files.weekly_files(spark, path)
    return rows.selectExpr(
        "file_start", "file_end", "file_week", "EAN as ean", "double(Units_Sold) as units",
        "double(Total_Revenue) as revenue",
    )


@query(
    "u1_weekly_files_to_sales",
    f"""{V1_WITH}, {A4} {_from_summary("a4", "ean").replace("%AD%", "coalesce(avg_ad_cost, 0)").replace("%WEEK%", "iso_week")}""",
)
def u1(spark, sf):
    path = scratch_path(spark, "weekly")
    exports.write_weekly(rollups.weekly_rollup(marketplace_lines(spark, sf)), path, compression="gzip")
    return sales_view.normalized_sales(files.weekly_files(spark, path))


@query(
    "s10_webshop_weekly_files",
    f"""{V2_WITH}, {A4_WS} select {_WEEK_KEYS}, sku, cast(total_units as double) as units,
    total_revenue as revenue, avg_margin_pct as margin_pct from a4""",
)
def s10_webshop(spark, sf):
    path = scratch_path(spark, "weekly")
    exports.write_weekly(rollups.weekly_rollup(webshop_lines(spark, sf)), path, compression="gzip")
    rows = files.weekly_files(spark, path, channel="webshop")
    return rows.selectExpr(
        "file_start", "file_end", "file_week", "SKU as sku", "double(Units) as units",
        "double(Revenue) as revenue", "double(`Margin%`) as margin_pct",
    )


@query("k7_summary_csv", f"""{V2_WITH}, {A2} select product_name as "Product", sku as "SKU",
    cast(total_units as varchar) as "Units_Sold", cast(cast(latest_order as date) as varchar) as day from a2""")
def k7(spark, sf):
    path = scratch_path(spark, "summary.csv")
    exports.write_summary(rollups.product_summary(webshop_lines(spark, sf)), path)
    return files.sales_csv(spark, path).selectExpr("Product", "SKU", "Units_Sold", "left(Latest_Order, 10) as day")


_ROWS = """select offer_id, product_name, ean, date, period_type, period_label,
    cast(visits_nl as bigint) as visits_nl, cast(visits_be as bigint) as visits_be,
    cast(visits_total as bigint) as visits_total, cast(orders as bigint) as orders,
    cast(conversion_rate as double) as conversion_rate from {src}"""


@query("s11_conversion_metrics_csv", METRICS_WITH + _ROWS.format(src="metrics"))
def s11(spark, sf):
    path = scratch_path(spark, "conversion")
    exports.write_conversion(metrics(spark, sf), daily(spark, sf), path)
    return board.normalize_rows(files.conversion_csv(spark, f"{path}/bol_conversion_metrics.csv"))


@query("p16_conversion_daily_csv", DAILY_WITH + _ROWS.format(src="daily"))
def p16(spark, sf):
    path = scratch_path(spark, "conversion")
    exports.write_csv(exports.daily_order(exports.conversion_export(daily(spark, sf))), path)
    return board.normalize_rows(files.conversion_csv(spark, path))


@query(
    "s12_table_counts",
    with_tables("mp_orders", "mp_offers", "mp_costs", "ws_orders", "ws_items")
    + """select 'raw.bol_orders' as table_name, count(*) as row_count from mp_orders
    union all select 'raw.bol_offers', count(*) from mp_offers
    union all select 'raw.bol_product_costs', count(*) from mp_costs
    union all select 'raw.shopify_orders', count(*) from ws_orders
    union all select 'raw.shopify_order_items', count(*) from ws_items
    union all select 'raw.shopify_product_costs', 0""",
)
def s12(spark, sf):
    """The last table is left out on purpose: a missing table counts 0."""
    names = ["mp_orders", "mp_offers", "mp_costs", "ws_orders", "ws_items"]
    raw = ["raw.bol_orders", "raw.bol_offers", "raw.bol_product_costs", "raw.shopify_orders", "raw.shopify_order_items"]
    return files.table_counts(spark, {t: table(spark, sf, n) for t, n in zip(raw, names)})
