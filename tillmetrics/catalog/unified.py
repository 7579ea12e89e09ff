"""Queries: both channels together, reports and dashboard questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics.catalog.mapping import read, table, with_tables
from tillmetrics.catalog.profit import STAGED_ORDERS
from tillmetrics.catalog.registry import query, r, xavg, xsum
from tillmetrics.operators.asof import asof_join
from tillmetrics.plans import reports, staging, unified

_UNIFIED = f"""mp_totals as (
    select order_id, min(order_placed_at) as order_placed_at, {r(xsum("total_price"), 2)} as total_price
    from mp_staged group by order_id),
unified as (
    select order_id, order_placed_at, total_price, 'bol' as channel, cast(null as varchar) as currency from mp_totals
    union all
    select order_id, created_at, total_price, 'shopify', currency from ws_orders
    where order_id is not null and total_price >= 0)"""
UNIFIED_WITH = with_tables("mp_orders", "ws_orders", more=f"{STAGED_ORDERS}, {_UNIFIED}")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    marketplace = unified.marketplace_order_totals(staging.marketplace_orders(table(spark, sf, "mp_orders")))
    webshop = staging.webshop_orders(table(spark, sf, "ws_orders")).selectExpr(
        "order_id", "created_at as order_placed_at", "total_price", "currency"
    )
    return unified.unified_orders(marketplace, webshop)


@query("x1_unified_orders", UNIFIED_WITH + "select * from unified")
def x1(spark, sf):
    return orders(spark, sf)


@query(
    "x2_json_extract",
    """select cast(o_orderkey as varchar) as order_id, o_orderdate as order_placed_at,
        cast(case when o_orderstatus <> 'P' then o_custkey end as decimal(10, 2)) as total_price,
        'EUR' as currency, o_orderstatus as financial_status, null::varchar as fulfillment_status from orders""",
)
def x2(spark, sf):
    raw = read(spark, sf, "orders").selectExpr(
        "string(o_orderkey) as order_id",
        """to_json(named_struct('created_at', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss"),
            'total_price', if(o_orderstatus = 'P', 'n/a', string(o_custkey)),
            'money', named_struct('currency', 'EUR'), 'financial_status', o_orderstatus)) as order_data""",
    )
    return unified.from_json_text(
        raw,
        "order_data",
        {
            "order_placed_at": ("$.created_at", "timestamp_ntz"),
            "total_price": ("$.total_price", "decimal(10,2)"),
            "currency": ("$.money.currency", "string"),
            "financial_status": ("$.financial_status", "string"),
            "fulfillment_status": ("$.fulfillment_status", "string"),
        },
    )


_PRODUCTS = """p as (
    select ean as product_id, product_title as product_name, ean as sku, cast(null as varchar) as category,
        unit_price as price, 'bol' as channel from mp_offers
    union all
    select sku, product_name, sku, 'cost list', original_price, 'shopify' from ws_costs),
dim as (select md5(concat_ws('-', product_id, channel)) as product_key, * from p)"""
_PRODUCTS_WITH = with_tables("mp_offers", "ws_costs", "mp_orders", "ws_items", "ws_orders", more=f"{STAGED_ORDERS}, {_PRODUCTS}")


def products(spark: SparkSession, sf: str) -> DataFrame:
    return unified.dim_products(
        table(spark, sf, "mp_offers").selectExpr(
            "ean as product_id", "product_title as product_name", "ean as sku", "string(null) as category",
            "unit_price as price",
        ),
        table(spark, sf, "ws_costs").selectExpr(
            "sku as product_id", "product_name", "sku", "'cost list' as category", "original_price as price"
        ),
    )


@query("x3_dim_products", _PRODUCTS_WITH + "select * from dim")
def x3(spark, sf):
    return products(spark, sf)


@query("x4_fct_orders", UNIFIED_WITH + "select md5(concat_ws('-', order_id, channel)) as order_key, * from unified")
def x4(spark, sf):
    return unified.fct_orders(orders(spark, sf))


_BY_CHANNEL = f"""by_channel as (
    select cast(order_placed_at as date) as order_date, channel, count(*) as total_orders,
        {r(xsum("total_price"), 2)} as total_revenue, {r(xavg("total_price"), 2)} as avg_order_value
    from unified group by 1, 2)"""


@query("x5_revenue_by_channel", f"{UNIFIED_WITH}, {_BY_CHANNEL} select * from by_channel")
def x5(spark, sf):
    return unified.revenue_by_channel(unified.fct_orders(orders(spark, sf)))


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    marketplace = staging.marketplace_orders(table(spark, sf, "mp_orders")).selectExpr(
        "ean as product_id", "'bol' as channel", "order_id", "quantity as units", "total_price as revenue"
    )
    webshop = staging.webshop_items(table(spark, sf, "ws_items")).selectExpr(
        "sku as product_id", "'shopify' as channel", "order_id", "quantity as units", "price * quantity as revenue"
    )
    return marketplace.unionByName(webshop)


_PERFORMANCE = f"""lines as (
    select md5(concat_ws('-', ean, 'bol')) as product_key, order_id, quantity as units, total_price as revenue from mp_staged
    union all
    select md5(concat_ws('-', sku, 'shopify')), order_id, quantity, price * quantity from ws_items
    where quantity > 0 and price >= 0),
per_order as (
    select product_key, order_id, sum(units) as units, {xsum("revenue")} as revenue from lines group by all),
per_product as (
    select product_key, count(order_id) as total_orders, sum(units) as units, {xsum("revenue")} as revenue
    from per_order group by all),
performance as (
    select d.product_name, d.sku, d.channel, cast(sum(total_orders) as bigint) as total_orders,
        cast(sum(units) as bigint) as units_sold, {r(xsum("revenue"), 2)} as total_revenue
    from per_product p join dim d on d.product_key = p.product_key group by 1, 2, 3)"""


@query("x6_product_performance", f"{_PRODUCTS_WITH}, {_PERFORMANCE} select * from performance")
def x6(spark, sf):
    return unified.product_performance(order_lines(spark, sf), products(spark, sf))


_WHEN = "1999-03-10"


@query(
    "x9_last_week_revenue_tab",
    f"""{UNIFIED_WITH}, {_BY_CHANNEL}
    select cast(order_date as varchar) as "Date", channel as "Channel", format('{{:,}}', total_orders) as "Total Orders",
        concat('€ ', format('{{:,.2f}}', total_revenue)) as "Revenue (€)",
        concat('€ ', format('{{:,.2f}}', avg_order_value)) as "Avg Order Value (€)"
    from by_channel where order_date between date '1999-03-01' and date '1999-03-07'""",
)
def x9(spark, sf):
    revenue = unified.revenue_by_channel(orders(spark, sf))
    return reports.revenue_tab(reports.in_last_week(revenue, "order_date", _WHEN))


@query(
    "x9_product_tab",
    f"""{_PRODUCTS_WITH}, {_PERFORMANCE}
    select product_name as "Product Name", sku as "SKU", format('{{:,}}', units_sold) as "Units Sold",
        concat('€ ', format('{{:,.2f}}', total_revenue)) as "Revenue (€)" from performance""",
)
def x9_products(spark, sf):
    return reports.product_tab(unified.product_performance(order_lines(spark, sf), products(spark, sf)))


@query(
    "x10_channel_split",
    f"""{UNIFIED_WITH}, c as (
        select channel, count(*) as total_orders, {r(xsum("total_price"), 2)} as revenue from unified group by 1)
    select *, {r("revenue / (select sum(revenue) from c) * 100", 2)} as share_pct from c""",
)
def x10_split(spark, sf):
    return unified.channel_split(orders(spark, sf))


@query(
    "x10_orders_by_weekday",
    UNIFIED_WITH + """select cast(isodow(order_placed_at) as integer) as weekday, count(*) as total_orders
    from unified group by 1""",
)
def x10_weekday(spark, sf):
    return unified.orders_by_weekday(orders(spark, sf))


@query(
    "x10_weekly_growth",
    f"""{UNIFIED_WITH}, w as (
        select channel, cast(date_trunc('week', order_placed_at) as date) as week_start,
            {r(xsum("total_price"), 2)} as revenue from unified group by 1, 2),
    l as (select *, lag(revenue) over (partition by channel order by week_start) as previous_revenue from w)
    select *, {r("(revenue - previous_revenue) / nullif(previous_revenue, 0) * 100", 2)} as growth_pct from l""",
)
def x10_growth(spark, sf):
    return unified.weekly_growth(orders(spark, sf))


@query(
    "x10_best_and_worst",
    f"""{_PRODUCTS_WITH}, {_PERFORMANCE}
    (select *, 'top' as list from performance order by total_revenue desc, channel, sku, product_name limit 10)
    union all
    (select *, 'bottom' as list from performance order by total_revenue, channel, sku, product_name limit 10)""",
)
def x10_best(spark, sf):
    return unified.best_and_worst(unified.product_performance(order_lines(spark, sf), products(spark, sf)))


@query(
    "x11_convert_currency",
    """select c_custkey, c_acctbal, n_name as currency,
        case when n_name = 'EUR' then c_acctbal else c_acctbal * coalesce(case when n_regionkey <> 2
             then 1 + n_nationkey / 8 end, 1) end as amount_eur
    from customer join nation on c_nationkey = n_nationkey""",
)
def x11(spark, sf):
    """Every nation has its own currency here; those of one region have no rate."""
    nations = read(spark, sf, "nation")
    rates = nations.filter("n_regionkey <> 2").selectExpr("n_name as currency", "1 + n_nationkey / 8 as rate")
    accounts = (
        read(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr("c_custkey", "c_acctbal", "n_name as currency")
    )
    return unified.convert_currency(accounts, "c_acctbal", "currency", rates, into="amount_eur")


_ASOF = """with facts as (
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, cast(l_shipdate as date) as day,
            case when l_suppkey % 3 = 0 then 0 when l_tax > 0.07 then null else l_partkey end as product
        from lineitem),
    changes as (
        select case when l_suppkey % 3 = 0 then 0 else l_partkey end as product, cast(l_shipdate + interval 20 days as date) as day,
            max(l_extendedprice * 0.4::double) as cogs
        from lineitem where l_returnflag = 'R' group by all)"""


@query(
    "x7_asof_costs",
    _ASOF
    + """ select f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, f.l_extendedprice, f.day, f.product, c.cogs
    from facts f asof left join changes c on f.product = c.product and f.day >= c.day""",
)
def x7_asof(spark, sf):
    """Every order line with the cost that was valid on its day; one product holds a third of the lines.

    Changes come from returned lines, twenty days later; of several on one day the highest counts.
    """
    lines = read(spark, sf, "lineitem")
    facts = lines.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "date(l_shipdate) as day",
        "case when l_suppkey % 3 = 0 then 0 when l_tax > 0.07 then null else l_partkey end as product",
    )
    changes = lines.filter("l_returnflag = 'R'").selectExpr(
        "if(l_suppkey % 3 = 0, 0, l_partkey) as product", "date_add(date(l_shipdate), 20) as changed",
        "l_extendedprice * 0.4D as cogs",
    )
    return asof_join(facts, changes, "product", "day", "changed", ["cogs"])
