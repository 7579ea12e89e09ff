"""Queries: the normalized sales view and the dashboard numbers on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics.catalog.mapping import read
from tillmetrics.catalog.profit import V1_WITH, V2_WITH, marketplace_lines, webshop_lines
from tillmetrics.catalog.registry import SQL, query, r, xavg, xsum
from tillmetrics.functions.flags import discount_flag
from tillmetrics.operators.ranking import page
from tillmetrics.plans import kpis, sales_view
from tillmetrics.session import scratch_path
from tillmetrics.sinks.pages import StoredPages

# marketplace lines under the kind of names that spreadsheets have
_NAMES = {
    "product_name": "Product", "ean": "EAN", "units_sold": "Units Sold", "revenue": "Total Revenue",
    "net_margin_pct": "Margin %", "selling_price": "Sale Price", "original_price": "List-Price",
    "date": "Latest_Order", "discount_used_pct": "Discount_Pct_Avg", "cogs": "COGS_Avg",
    "estimated_ad_cost": "Ad Cost", "net_margin_eur": "Margin_EUR_Avg",
}


def relation(spark: SparkSession, sf: str) -> DataFrame:
    return marketplace_lines(spark, sf).select(*[F.col(c).alias(n) for c, n in _NAMES.items()])


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return sales_view.normalized_sales(relation(spark, sf))


SALES = f"""sales as (
    select coalesce(product_name, '(Unknown)') as product_name, coalesce(ean, '') as ean,
        coalesce(units_sold::double, 0) as units_sold, coalesce(revenue, 0) as revenue,
        {r("coalesce(units_sold::double, 0) * coalesce(selling_price / 1.21::double, 0)", 2)} as revenue_ex_vat,
        coalesce(selling_price / 1.21::double, 0) as net_selling_price,
        coalesce(selling_price, 0) as selling_price,
        coalesce(nullif(original_price, 0), selling_price, 0) as original_price,
        case when original_price > 0 and selling_price > 0
             then {r("(original_price - selling_price) / original_price * 100", 1)}
             else coalesce(discount_used_pct, 0) end as discount_used_pct,
        coalesce(cogs, 0) as cogs, coalesce(estimated_ad_cost, 0) as estimated_ad_cost,
        coalesce(net_margin_eur, 0) as net_margin_eur,
        greatest(-100, least(100, coalesce(net_margin_pct, 0))) as net_margin_pct,
        cast(date as date) as order_date, cast(extract(week from date) as integer) as week_number,
        coalesce(discount_used_pct > 0, false) as discount_applied
    from v1)"""
SALES_WITH = f"{V1_WITH}, {SALES} "


@query("p13_sales_norm", SALES_WITH + "select * from sales")
def p13(spark, sf):
    return sales(spark, sf)


# web-shop lines with money as text
_WEB_TEXT = {
    "Week": "concat('Week ', weekofyear(date))",
    "Product": "product_name",
    "SKU": "sku",
    "Latest": "string(date)",
    "Units": "string(units_sold)",
    "Sell": "concat('€ ', string(selling_price))",
    "Original": "concat(string(original_price), ' €')",
    "Disc%": "string(discount_used_pct)",
    "Revenue": "string(revenue)",
    "net_margin_eur": "string(net_margin_eur)",
    "Ad": "string(estimated_ad_cost)",
    "COGS": "string(cogs)",
}


def webshop_sales(spark: SparkSession, sf: str) -> DataFrame:
    text = webshop_lines(spark, sf).selectExpr(*[f"{sql} as `{n}`" for n, sql in _WEB_TEXT.items()])
    return sales_view.normalized_sales(text, channel="webshop")


@query(
    "p14_webshop_text_columns",
    f"""{V2_WITH}, t as (select *, selling_price as sell, original_price as orig from v2)
    select coalesce(product_name, '(Unknown)') as product_name, coalesce(sku, '') as ean,
        coalesce(units_sold::double, 0) as units_sold, coalesce(revenue, 0) as revenue,
        {r("coalesce(units_sold::double, 0) * coalesce(sell / 1.21::double, 0)", 2)} as revenue_ex_vat,
        coalesce(sell / 1.21::double, 0) as net_selling_price, coalesce(sell, 0) as selling_price,
        coalesce(nullif(orig, 0), sell, 0) as original_price,
        case when orig > 0 and sell > 0 then {r("(orig - sell) / orig * 100", 1)}
             else coalesce(discount_used_pct, 0) end as discount_used_pct,
        coalesce(cogs, 0) as cogs, coalesce(estimated_ad_cost, 0) as estimated_ad_cost,
        coalesce(net_margin_eur, 0) as net_margin_eur, 0.0::double as net_margin_pct,
        cast(date as date) as order_date, cast(extract(week from date) as integer) as week_number,
        false as discount_applied
    from t""",
)
def p14(spark, sf):
    return webshop_sales(spark, sf)


@query("p15_read_out", SALES_WITH + "select * replace (cast(order_date as varchar) as order_date) from sales")
def p15(spark, sf):
    return sales_view.read_out(sales(spark, sf))


@query(
    "p20_discount_flag",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_returnflag when 'A' then l_discount > 0
        when 'N' then l_linestatus = 'O' else false end as flag from lineitem""",
)
def p20(spark, sf):
    raw = """case l_returnflag when 'A' then string(l_discount)
        when 'N' then if(l_linestatus = 'O', ' Yes ', 'No') else if(l_linestatus = 'O', null, '-1.5') end"""
    rows = read(spark, sf, "lineitem").withColumn("raw", F.expr(raw))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", discount_flag(F.col("raw")).alias("flag")
    )


@query(
    "f3_filter",
    SALES_WITH
    + """select * from sales where week_number = 9 and order_date >= date '1996-01-01'
    and order_date <= date '1999-12-31' and product_name in ('Part 1', 'Part 7', 'Part 11', 'Part 150')""",
)
def f3(spark, sf):
    return sales_view.filtered(
        sales(spark, sf), 9, "1996-01-01", "1999-12-31", ["Part 1", "Part 7", "Part 11", "Part 150"]
    )


@query(
    "f3_filter_by_product_set",
    SALES_WITH
    + """select * from sales where product_name in (
        select concat('Part ', p_partkey) from part where p_name = 'red widget')""",
)
def f3_set(spark, sf):
    wanted = read(spark, sf, "part").filter("p_name = 'red widget'").selectExpr(
        "concat('Part ', p_partkey) as product_name"
    )
    return sales_view.filtered(sales(spark, sf), products=wanted)


def _kpi_sql(rate: str) -> str:
    return f"""t as (
        select coalesce({xsum("units_sold")}, 0) as total_units, {xsum("revenue")} as rev,
            {xsum("revenue_ex_vat", 2)} as rev_ex, greatest(count(distinct week_number), 1) as week_count,
            {r(xavg("net_margin_pct"), 1)} as avg_margin_pct, {r(xavg(rate), 1)} as discount_rate from sales)
    select total_units, week_count, avg_margin_pct, discount_rate, {r("rev", 2)} as total_revenue,
        {r("rev_ex", 2)} as total_revenue_ex_vat, {r("rev / week_count", 2)} as avg_weekly_revenue,
        {r("rev_ex / week_count", 2)} as avg_weekly_revenue_ex_vat from t"""


_SHARE = "(case when discount_applied then 100.0::double else 0.0::double end)"


@query("a7_kpis", f"{SALES_WITH}, {_kpi_sql(_SHARE)}")
def a7(spark, sf):
    return kpis.headline(sales(spark, sf))


@query("a7_kpis_mean_discount", f"{SALES_WITH}, {_kpi_sql('discount_used_pct')}")
def a7_mean(spark, sf):
    return kpis.headline(sales(spark, sf), discount_share=False)


@query(
    "a8_by_product",
    SALES_WITH
    + f"""select product_name, {r(xsum("units_sold"), 2)} as units_sold, {r(xsum("revenue"), 2)} as revenue,
        {r(xavg("net_margin_pct"), 1)} as margin_pct from sales group by product_name""",
)
def a8(spark, sf):
    return kpis.by_product(sales(spark, sf))


@query("a9_discount_split", SALES_WITH + 'select discount_applied, count(*) as "rows" from sales group by 1')
def a9(spark, sf):
    return kpis.discount_split(sales(spark, sf))


@query(
    "a10_leaders",
    f"""{SALES_WITH}, p as (
        select product_name, {xsum("units_sold")} as units, {xsum("revenue")} as revenue,
               {xsum("net_margin_eur * units_sold")} as profit from sales group by product_name),
    s as (select * from p where units > 0 order by units desc, product_name limit 1),
    m as (select * from p order by profit desc, product_name limit 1)
    select s.product_name as top_seller, {r("s.units", 2)} as top_seller_units,
        {r("s.revenue", 2)} as top_seller_revenue, m.product_name as most_profitable,
        {r("m.profit", 2)} as most_profitable_profit, {r("m.units", 2)} as most_profitable_units from s, m""",
)
def a10(spark, sf):
    return kpis.leaders(sales(spark, sf))


@query(
    "a14_filter_domains",
    SALES_WITH
    + """select distinct 'week' as kind, cast(week_number as varchar) as value from sales
    union all select distinct 'product', product_name from sales where product_name <> ''
    union all select 'min_date', cast(min(order_date) as varchar) from sales
    union all select 'max_date', cast(max(order_date) as varchar) from sales""",
)
def a14(spark, sf):
    return kpis.filter_domains(sales(spark, sf))


@query(
    "o2_page",
    SALES_WITH
    + """select * from sales order by revenue desc, product_name, ean, units_sold, revenue_ex_vat,
        net_selling_price, selling_price, original_price, discount_used_pct, cogs, estimated_ad_cost,
        net_margin_eur, net_margin_pct, order_date, week_number, discount_applied limit 10 offset 20""",
)
def o2(spark, sf):
    return page(sales(spark, sf), "revenue", descending=True, number=3)


@query("o2_deep_page", SQL["o2_page"].replace("offset 20", "offset 49990"))
def o2_deep(spark, sf):
    """Page 5,000 out of stored ranges of the sort order."""
    stored = StoredPages(spark, scratch_path(spark, "pages"), rows_per_range=5_000)
    stored.write(sales(spark, sf), "revenue", descending=True)
    return stored.page(5_000)
