"""Queries: profitability per line, rollups, latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics.catalog.mapping import read, table, with_tables
from tillmetrics.catalog.registry import query, r, xavg, xsum
from tillmetrics.fixed import SUMMARY_HEADERS
from tillmetrics.operators.keyed import first_per_key
from tillmetrics.operators.ranking import latest_rows
from tillmetrics.plans import increments, profitability, rollups, staging
from tillmetrics.session import freed_shuffles, scratch_path
from tillmetrics.sinks.exports import summary_report, weekly_report


def marketplace_lines(
    spark: SparkSession, sf: str, start: str | None = None, end: str | None = None, **options
) -> DataFrame:
    return profitability.marketplace_profitability(
        staging.marketplace_orders(table(spark, sf, "mp_orders"), start, end),
        staging.marketplace_offers(table(spark, sf, "mp_offers")),
        table(spark, sf, "mp_costs"),
        **options,
    )


def webshop_lines(spark: SparkSession, sf: str) -> DataFrame:
    return profitability.webshop_profitability(
        staging.webshop_items(table(spark, sf, "ws_items")),
        staging.webshop_orders(table(spark, sf, "ws_orders")),
        table(spark, sf, "ws_costs"),
    )


STAGED_ORDERS = """mp_staged as (
    select * replace (try_cast(order_placed_at as timestamp) as order_placed_at) from mp_orders
    where order_id is not null and order_item_id is not null and quantity > 0 and unit_price > 0)"""
STAGED_OFFERS = "of_staged as (select * from mp_offers where offer_id is not null and ean is not null)"


def _marketplace_sql(
    offers: str = "of_staged", original: str | None = None, commission: bool = True, orders: str = "mp_staged"
) -> str:
    """Profit per marketplace line: first what a line costs and lists at, then its net price and margin."""
    original = original or "coalesce(nullif(c.original_price, 0), f.unit_price)"
    fee = " - fee" if commission else ""
    return f"""
    select order_id, order_item_id, date, product_name, ean, units as units_sold, price as selling_price,
        fee as {"bol_commission" if commission else "commission"}, listed as original_price, cogs,
        ads as estimated_ad_cost, cogs * units as cogs_total, {r("net", 2)} as net_selling_price,
        case when listed > 0 then {r("(listed - price) / listed * 100", 1)} else 0.0::double end as discount_used_pct,
        {r("margin", 2)} as net_margin_eur,
        case when price > 0 then {r("margin / net * 100", 1)} else 0.0::double end as net_margin_pct,
        price * units as revenue, {r("margin * units", 2)} as profit
    from (
        select *, net - cogs - ads{fee} as margin from (
            select o.order_id, o.order_item_id, o.order_placed_at as date, o.title as product_name, ean,
                o.quantity as units, o.unit_price as price, o.unit_price / 1.21::double as net, o.commission as fee,
                {original} as listed, coalesce(c.cogs, 0) as cogs, coalesce(c.estimated_ad_cost, 0) as ads
            from {orders} o left join {offers} f using (ean) left join mp_costs c using (ean)))"""


V1 = f"v1 as ({_marketplace_sql()})"
V1_WITH = with_tables(
    "mp_orders", "mp_offers", "mp_costs", more=f"{STAGED_ORDERS}, {STAGED_OFFERS}, {V1}"
)

def _webshop_sql(where: str = "i.line_item_id is not null and i.quantity > 0 and i.price >= 0 and h.total_price >= 0") -> str:
    """Profit per web-shop line: the price paid, then net price and partner's share, and the margin from these."""
    return f"""
    select order_id, line_item_id, date, product_name, sku, units as units_sold, paid as selling_price,
        listed as original_price, cogs, ads as estimated_ad_cost, {r("share", 2)} as shopify_affiliate_fee,
        cogs * units as cogs_total, {r("net", 2)} as net_selling_price,
        {r("if(listed > 0, (listed - paid) / listed, 0)", 3)} * 100 as discount_used_pct,
        {r("margin", 2)} as net_margin_eur, paid * units as revenue, {r("margin * units", 2)} as profit
    from (
        select *, net - cogs - share as margin from (
            select *, paid / 1.21::double as net, if(partner, paid * 0.12::double, 0.0::double) as share from (
                select h.order_id, h.created_at as date, h.landing_site is not null as partner, i.line_item_id, sku,
                    i.quantity as units, (i.price * i.quantity - i.total_discount) / nullif(i.quantity, 0) as paid,
                    coalesce(c.product_name, i.name) as product_name, coalesce(c.original_price, i.price) as listed,
                    coalesce(c.cogs, 0) as cogs, coalesce(c.estimated_ad_cost, 0) as ads
                from ws_items i join ws_orders h using (order_id) left join ws_costs c using (sku)
                where {where})))"""


V2 = f"v2 as ({_webshop_sql()})"
V2_WITH = with_tables("ws_items", "ws_orders", "ws_costs", more=V2)


@query("v1_marketplace_profitability", V1_WITH + "select * from v1")
def v1(spark, sf):
    return marketplace_lines(spark, sf)


@query(
    "v1_gross_of_commission",
    with_tables("mp_orders", "mp_offers", "mp_costs", more=f"{STAGED_ORDERS}, {STAGED_OFFERS}")
    + _marketplace_sql(original="f.unit_price", commission=False),
)
def v1_gross(spark, sf):
    return marketplace_lines(spark, sf, after_commission=False)


@query(
    "v1_unfiltered",
    with_tables("mp_orders", "mp_offers", "mp_costs") + _marketplace_sql(offers="mp_offers", orders="mp_orders"),
)
def v1_unfiltered(spark, sf):
    """The same over the raw tables, order moments as they were landed."""
    return profitability.marketplace_profitability(
        *(table(spark, sf, t) for t in ("mp_orders", "mp_offers", "mp_costs"))
    )


_V2_RAW = f"v2 as ({_webshop_sql('true')})"


@query(
    "v2_unfiltered",
    with_tables("ws_items", "ws_orders", "ws_costs", more=_V2_RAW.replace("coalesce(c.product_name, i.name)", "i.name"))
    + "select * from v2",
)
def v2_unfiltered(spark, sf):
    """Raw web-shop tables, products named as on the order line."""
    return profitability.webshop_profitability(
        *(table(spark, sf, t) for t in ("ws_items", "ws_orders", "ws_costs")), listed_name=False
    )


# a second offer for the large parts: their lines appear once per offer
_SECOND_OFFER = """mp_two as (
    select * from mp_offers union all
    select * replace (concat('O2-', ean) as offer_id, unit_price * 0.9::double as unit_price)
    from mp_offers where managed_by_retailer)"""


def two_offers(spark: SparkSession, sf: str) -> DataFrame:
    offers = table(spark, sf, "mp_offers")
    second = offers.filter("managed_by_retailer").withColumns(
        {"offer_id": F.concat(F.lit("O2-"), "ean"), "unit_price": F.col("unit_price") * 0.9}
    )
    return offers.unionByName(second)


@query(
    "j1_offer_fan_out",
    with_tables("mp_orders", "mp_offers", "mp_costs", more=f"{STAGED_ORDERS}, {_SECOND_OFFER}")
    + _marketplace_sql(offers="mp_two"),
)
def j1_fan_out(spark, sf):
    return profitability.marketplace_profitability(
        staging.marketplace_orders(table(spark, sf, "mp_orders")),
        staging.marketplace_offers(two_offers(spark, sf)),
        table(spark, sf, "mp_costs"),
    )


@query(
    "j1_one_offer_per_ean",
    with_tables(
        "mp_orders", "mp_offers", "mp_costs",
        more=f"""{STAGED_ORDERS}, {_SECOND_OFFER},
    one as (select * from mp_two qualify row_number() over (partition by ean order by offer_id) = 1)""",
    )
    + _marketplace_sql(offers="one"),
)
def j1_one_offer(spark, sf):
    return profitability.marketplace_profitability(
        staging.marketplace_orders(table(spark, sf, "mp_orders")),
        staging.marketplace_offers(two_offers(spark, sf)),
        table(spark, sf, "mp_costs"),
        dedupe_offers=True,
    )


@query("v2_webshop_profitability", V2_WITH + "select * from v2")
def v2(spark, sf):
    return webshop_lines(spark, sf)


@query(
    "p11_staged_orders",
    with_tables("mp_orders", more=STAGED_ORDERS) + "select * from mp_staged",
)
def p11(spark, sf):
    return staging.marketplace_orders(table(spark, sf, "mp_orders"))


@query(
    "p11_staged_offers",
    with_tables("mp_offers", more=STAGED_OFFERS) + "select * from of_staged",
)
def p11_offers(spark, sf):
    return staging.marketplace_offers(table(spark, sf, "mp_offers"))


@query(
    "p11_staged_webshop_orders",
    with_tables("ws_orders") + "select * from ws_orders where order_id is not null and total_price >= 0",
)
def p11_webshop_orders(spark, sf):
    return staging.webshop_orders(table(spark, sf, "ws_orders"))


@query(
    "p11_staged_webshop_items",
    with_tables("ws_items")
    + """select * from ws_items where line_item_id is not null and order_id is not null
    and quantity > 0 and price >= 0""",
)
def p11_webshop_items(spark, sf):
    return staging.webshop_items(table(spark, sf, "ws_items"))


@query(
    "p12_line_item_base",
    V2_WITH
    + """select order_id, line_item_id, selling_price, original_price, cogs, estimated_ad_cost, product_name
    from v2""",
)
def p12(spark, sf):
    return webshop_lines(spark, sf).select(
        "order_id", "line_item_id", "selling_price", "original_price", "cogs", "estimated_ad_cost",
        "product_name",
    )


def _measures(margin: str, ad_cost: bool) -> str:
    ad = f"{r(xavg('estimated_ad_cost'), 2)} as avg_ad_cost," if ad_cost else ""
    return f"""cast(sum(units_sold) as bigint) as total_units,
        {r(xavg("cogs"), 2)} as avg_cogs, {ad}
        {r(xavg("selling_price"), 2)} as avg_selling_price,
        {r(xavg("original_price"), 2)} as avg_original_price,
        {r(xavg("discount_used_pct", 1), 1)} as avg_discount_pct,
        {r(xavg("net_margin_eur", 2), 2)} as avg_net_margin,
        {margin} as avg_margin_pct,
        {r(xsum("revenue"), 2)} as total_revenue,
        {r(xsum("profit", 2), 2)} as total_profit"""


_MP_PCT = r(xavg("net_margin_pct", 1), 1)
_WS_PCT = r(xavg("net_margin_eur / nullif(selling_price / 1.21::double, 0)") + " * 100", 1)
A1 = f"""a1 as (select product_name, ean, max(date) as latest_order, {_measures(_MP_PCT, False)}
    from v1 group by product_name, ean)"""
A2 = f"""a2 as (select product_name, sku, max(date) as latest_order, {_measures(_WS_PCT, False)}
    from v2 group by product_name, sku)"""


def _weekly_sql(view: str, key: str, margin: str, where: str = "") -> str:
    return f"""select cast(date_trunc('week', cast(date as date)) as date) as week_start,
        cast(date_trunc('week', cast(date as date)) as date) + 6 as week_end,
        cast(extract(week from cast(date as date)) as integer) as iso_week,
        product_name, {key}, max(cast(date as date)) as latest_order, {_measures(margin, True)}
    from {view} {where} group by 1, 2, 3, 4, 5"""


A4 = f"a4 as ({_weekly_sql('v1', 'ean', _MP_PCT)})"
A4_WS = f"a4 as ({_weekly_sql('v2', 'sku', _WS_PCT)})"


@query("a1_product_summary", f"{V1_WITH}, {A1} select * from a1")
def a1(spark, sf):
    return rollups.newest_first(rollups.product_summary(marketplace_lines(spark, sf)))


@query("a2_webshop_summary", f"{V2_WITH}, {A2} select * from a2")
def a2(spark, sf):
    return rollups.newest_first(rollups.product_summary(webshop_lines(spark, sf)))


_LABELS = ", ".join(f'{c} as "{label}"' for c, label in SUMMARY_HEADERS if c not in ("product_name", "product_key"))


@query("a3_marketplace_report", f'{V1_WITH}, {A1} select product_name as "Product", ean as "EAN", {_LABELS} from a1')
def a3_marketplace(spark, sf):
    return summary_report(rollups.product_summary(marketplace_lines(spark, sf)))


@query("a3_webshop_report", f'{V2_WITH}, {A2} select product_name as "Product", sku as "SKU", {_LABELS} from a2')
def a3_webshop(spark, sf):
    return summary_report(rollups.product_summary(webshop_lines(spark, sf)))


@query("a4_weekly_rollup", f"{V1_WITH}, {A4} select * from a4")
def a4(spark, sf):
    return rollups.weekly_rollup(marketplace_lines(spark, sf))


@query("a4_incremental", f"{V1_WITH}, {A4} select * from a4")
def a4_incremental(spark, sf):
    """The same rollup after three loads: some lines wrong and some that do not belong, corrections and
    the other lines, and a delete. The second load is repeated."""
    path = scratch_path(spark, "lines")
    with freed_shuffles(spark):
        marketplace_lines(spark, sf).write.parquet(path)
    right, half = spark.read.parquet(path), F.abs(F.xxhash64("order_item_id")) % 2 == 0
    wrong = right.filter(half).withColumns({"units_sold": F.col("units_sold") + 3, "profit": F.col("profit") - 1.5})
    late = F.date_add(F.col("date").cast("date"), 2).cast(right.schema["date"].dataType)
    extra = right.filter(~half).withColumn("date", late)
    first = wrong.unionByName(extra)
    rollup = increments.WeeklyRollup(spark, scratch_path(spark, "weeks"), right)
    rollup.load(1, first, first.filter("false"), first)
    # No one else reads the table, so versions that a load has replaced can go.
    rollup.table.vacuum()
    corrected = right.unionByName(extra)
    for _ in range(2):
        rollup.load(2, right, increments.replaced_lines(wrong, right, ["order_id", "order_item_id"]), corrected)
        rollup.table.vacuum()
    rollup.load(3, right.filter("false"), extra, right)
    rollup.table.vacuum()
    return rollup.read()


@query("a4_webshop_weekly_rollup", f"{V2_WITH}, {A4_WS} select * from a4")
def a4_webshop(spark, sf):
    return rollups.weekly_rollup(webshop_lines(spark, sf))


@query(
    "f2_weekly_in_range",
    f"""{V1_WITH}, a4 as ({_weekly_sql('v1', 'ean', _MP_PCT,
        "where cast(date as date) between date '1998-12-20' and date '1999-01-10'")})
    select * from a4""",
)
def f2(spark, sf):
    lines = marketplace_lines(spark, sf, "1998-12-20", "1999-01-10")
    return rollups.by_week_and_revenue(rollups.weekly_rollup(lines, "1998-12-20", "1999-01-10"))


@query(
    "k8_weekly_report",
    f"""{V1_WITH}, {A4}
    select week_start, week_end, iso_week, concat('Week ', iso_week) as "Week",
        concat(strftime(week_start, '%B %-d'), '-', strftime(week_end, '%B %-d, %Y')) as "Date Range",
        coalesce(product_name, '') as "Product", coalesce(ean, '') as "EAN",
        coalesce(cast(latest_order as varchar), '') as "Latest_Order",
        coalesce(total_units, 0) as "Units_Sold", coalesce(avg_cogs, 0) as "COGS_Avg",
        coalesce(avg_ad_cost, 0) as "Ad_Cost_Avg", coalesce(avg_selling_price, 0) as "Sell_Price_Avg",
        coalesce(avg_original_price, 0) as "Original_Price_Avg",
        coalesce(avg_discount_pct, 0) as "Discount_Pct_Avg",
        coalesce(avg_net_margin, 0) as "Margin_EUR_Avg", coalesce(avg_margin_pct, 0) as "Margin_PCT_Avg",
        coalesce(total_revenue, 0) as "Total_Revenue", coalesce(total_profit, 0) as "Total_Profit"
    from a4""",
)
def k8_report(spark, sf):
    return weekly_report(rollups.weekly_rollup(marketplace_lines(spark, sf)))


_TOTAL = f"""select cast(coalesce(sum(total_units), 0) as bigint) as total_units,
    coalesce({r(xsum("total_revenue", 2), 2)}, 0) as total_revenue,
    coalesce({r(xsum("total_profit", 2), 2)}, 0) as total_profit"""


@query("a15_grand_total", f"{V1_WITH}, {A1} {_TOTAL} from a1")
def a15(spark, sf):
    return rollups.grand_total(rollups.product_summary(marketplace_lines(spark, sf)))


@query(
    "o1_latest_rows",
    f"""{V1_WITH} select * from v1 order by date desc nulls last, order_id, order_item_id, revenue,
    bol_commission nulls last, ean limit 100""",
)
def o1(spark, sf):
    ties = ["order_id", "order_item_id", "revenue", "bol_commission", "ean"]
    return latest_rows(marketplace_lines(spark, sf), 100, ties=ties)


@query(
    "d3_last_per_key",
    """select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc,
    l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) = 1""",
)
def d3(spark, sf):
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    return first_per_key(
        read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], *[F.col(c).desc() for c in order]
    )
