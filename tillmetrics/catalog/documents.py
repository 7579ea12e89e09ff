"""Queries: landed JSON documents, built from the tables, written, read and flattened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics.catalog.conversion import period_documents
from tillmetrics.catalog.mapping import REFERENCE_DAY, read
from tillmetrics.catalog.registry import query
from tillmetrics.functions.num import clean_number
from tillmetrics.operators import flatten, insights
from tillmetrics.session import scratch_path
from tillmetrics.sources import landing


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per order line, with the line and a service item."""
    return read(spark, sf, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) as orderId",
        "concat(date(l_shipdate), 'T10:00:00+01:00') as orderPlacedDateTime",
        "date(l_shipdate) as change_date",
        """array(
            named_struct('orderItemId', concat(l_orderkey, '/', l_linenumber),
                'product', named_struct('ean', string(l_partkey), 'title', concat('Part ', l_partkey)),
                'fulfilment', named_struct('method', if(l_linestatus = 'O', 'FBR', null)),
                'quantity', int(l_quantity), 'unitPrice', l_extendedprice / nullif(l_quantity, 0),
                'totalPrice', l_extendedprice, 'commission', nullif(l_tax, 0D)),
            named_struct('orderItemId', concat(l_orderkey, '/', l_linenumber, '/s'),
                'product', if(l_returnflag = 'R', null, named_struct('ean', 'SERVICE', 'title', string(null))),
                'fulfilment', named_struct('method', string(null)),
                'quantity', 1, 'unitPrice', l_discount, 'totalPrice', l_discount, 'commission', double(null)))
            as orderItems""",
        "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
    )


_ITEMS_SQL = """
    select concat(l_orderkey, '-', l_linenumber) as order_id,
        concat(l_orderkey, '/', l_linenumber) as order_item_id,
        concat(cast(l_shipdate as date), 'T10:00:00+01:00') as order_placed_at,
        case when l_linestatus = 'O' then 'FBR' end as fulfillment_method,
        cast(l_partkey as varchar) as ean, concat('Part ', l_partkey) as title,
        cast(l_quantity as integer) as quantity, l_extendedprice / l_quantity as unit_price,
        l_extendedprice as total_price, nullif(l_tax, 0) as commission
    from {src}
    union all
    select concat(l_orderkey, '-', l_linenumber), concat(l_orderkey, '/', l_linenumber, '/s'),
        concat(cast(l_shipdate as date), 'T10:00:00+01:00'), null,
        case when l_returnflag <> 'R' then 'SERVICE' end, null, 1, l_discount, l_discount, null
    from {src}"""


@query("p1_flatten_orders", _ITEMS_SQL.format(src="lineitem"))
def p1(spark, sf):
    documents = order_documents(spark, sf).select("orderId", "orderPlacedDateTime", "orderItems")
    return flatten.order_items(documents).drop("item_pos")


def land(df: DataFrame, spark: SparkSession, name: str, *folders: str) -> str:
    """Write rows as JSON lines below the shared folder, packed: plain text is some ten times as large.

    A packed file is read by one task, so files have a million rows at most.
    """
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=1_000_000)
    (writer.partitionBy(*folders) if folders else writer).json(path)
    return path


_FIRST_YEAR = "l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01'"


@query(
    "s1_landed_orders",
    f"""select concat(l_orderkey, '-', l_linenumber) as order_id, min(cast(l_shipdate as date)) as first_change,
        cast(2 as bigint) as items
    from lineitem where {_FIRST_YEAR} group by l_orderkey, l_linenumber""",
)
def s1(spark, sf):
    """All documents are landed; the year is the date range asked of the source."""
    documents = order_documents(spark, sf).select("orderId", "orderPlacedDateTime", "orderItems", "change_date")
    path = land(documents, spark, "orders")
    items = flatten.order_items(landing.marketplace_order_documents(spark, path, "1996-01-01", "1996-12-31"))
    return items.groupBy("order_id").agg(
        F.min("change_date").alias("first_change"), F.count(F.lit(1)).alias("items")
    )


@query(
    "d1_first_per_order",
    """select concat(l_orderkey, '-', l_linenumber) as order_id, cast(l_shipdate as date) as change_date,
        l_partkey, l_suppkey, l_extendedprice, l_returnflag from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag) = 1""",
)
def d1(spark, sf):
    documents = order_documents(spark, sf)
    seen = landing.first_seen(documents, ["l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"])
    return seen.selectExpr(
        "orderId as order_id", "change_date", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    )


@query(
    "s2_landed_offers",
    """select concat('OF-', p_partkey) as offer_id, cast(p_partkey as varchar) as ean, p_name as product_title,
        case when p_type = 'SMALL' then 0 else p_size end as stock_amount,
        case when p_type = 'SMALL' then 0 else p_size - 1 end as corrected_stock,
        p_type = 'LARGE' as managed_by_retailer,
        case when p_type <> 'PROMO' then p_retailprice end as unit_price,
        'FBR' as fulfillment_method, '24uurs-23' as delivery_code from part""",
)
def s2(spark, sf):
    """Pages of fifty offers, as the offer list delivers them."""
    offer = """named_struct('offerId', concat('OF-', p_partkey), 'ean', string(p_partkey),
        'unknownProductTitle', p_name,
        'stock', if(p_type = 'SMALL', null,
            named_struct('amount', p_size, 'correctedStock', p_size - 1, 'managedByRetailer', p_type = 'LARGE')),
        'pricing', named_struct('bundlePrices', if(p_type = 'PROMO', array(),
            array(named_struct('unitPrice', p_retailprice), named_struct('unitPrice', 1D)))),
        'fulfilment', named_struct('method', 'FBR', 'deliveryCode', '24uurs-23'))"""
    pages = (
        read(spark, sf, "part")
        .groupBy(F.expr("int(floor(p_partkey / 50))").alias("page"))
        .agg(F.collect_list(F.expr(offer)).alias("offers"))
    )
    return landing.marketplace_offers(spark, land(pages, spark, "offers"))


def _webshop_pages(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").selectExpr(
        """array(named_struct('id', o_orderkey,
            'created_at', concat(date(o_orderdate), 'T23:30:00Z'),
            'total_price', string(o_totalprice),
            'subtotal_price', if(o_orderstatus = 'P', '', string(o_totalprice / 2)),
            'total_tax', if(o_orderstatus = 'F', null, '1.5'), 'currency', 'EUR',
            'landing_site', if(o_orderpriority = '1-URGENT', '/ref', null),
            'line_items', array(
                named_struct('id', o_orderkey * 10, 'sku', string(o_custkey), 'name', 'First', 'quantity', 2,
                    'price', string(o_totalprice / 4), 'total_discount', '0.00'),
                named_struct('id', o_orderkey * 10 + 1, 'sku', string(null), 'name', 'Second', 'quantity', 1,
                    'price', string(null), 'total_discount', string(null))))) as orders"""
    )


_RANGE = "cast(o_orderdate as date) between date '1996-02-01' and date '1998-07-31'"


@query(
    "s3_landed_webshop_orders",
    f"""select cast(o_orderkey as varchar) as order_id, concat(cast(o_orderdate as date), 'T23:30:00Z') as created_at,
        o_totalprice as total_price, case when o_orderstatus = 'P' then 0 else o_totalprice / 2 end as subtotal_price,
        case when o_orderstatus = 'F' then 0.0::double else 1.5::double end as total_tax, 'EUR' as currency,
        case when o_orderpriority = '1-URGENT' then '/ref' end as landing_site
    from orders where {_RANGE}""",
)
def s3(spark, sf):
    path = land(_webshop_pages(spark, sf), spark, "webshop")
    return flatten.webshop_order_headers(landing.webshop_orders(spark, path, "1996-02-01", "1998-07-31"))


@query(
    "p3_flatten_items",
    """select cast(o_orderkey as varchar) as order_id, cast(o_orderkey * 10 as varchar) as line_item_id,
        cast(o_custkey as varchar) as sku, 'First' as name, 2 as quantity, o_totalprice / 4 as price,
        0.0::double as total_discount, case when o_orderpriority = '1-URGENT' then '/ref' end as landing_site,
        concat(cast(o_orderdate as date), 'T23:30:00Z') as created_at from orders
    union all
    select cast(o_orderkey as varchar), cast(o_orderkey * 10 + 1 as varchar), null, 'Second', 1, 0, 0,
        case when o_orderpriority = '1-URGENT' then '/ref' end,
        concat(cast(o_orderdate as date), 'T23:30:00Z') from orders""",
)
def p3(spark, sf):
    return flatten.webshop_line_items(_webshop_pages(spark, sf).selectExpr("inline(orders)"))


@query(
    "s4_landed_insights",
    """with p as (
        select 'WEEK' as period_type, date '2024-01-15' as a, date '2024-01-21' as b
        union all select 'MONTH', date '2024-01-01', date '2024-01-31'),
    n as (
        select concat('OF-', user_id) as offer_id, period_type, count(*) filter (value < 150) as nl,
               count(*) filter (value >= 150 and value < 300) as be, count(*) as n
        from events join p on cast(ts as date) between a and b where event_type = 'view' group by all)
    select offer_id, period_type, nl as visits_nl, be as visits_be, if(nl + be = 0, n, nl + be) as visits_total from n""",
)
def s4(spark, sf):
    path = land(period_documents(spark, sf, "both", REFERENCE_DAY), spark, "insights")
    return insights.country_visits(landing.insights(spark, path)).drop("payload")


_PRODUCT = """named_struct('id', p_partkey, 'title', p_name, 'variants', array(
    named_struct('id', p_partkey * 10, 'title', if(p_size > 25, 'Default Title', p_brand),
        'sku', string(p_partkey), 'price', string(p_retailprice), 'compare_at_price', string(null),
        'inventory_quantity', p_size, 'updated_at', '2024-01-01'),
    named_struct('id', p_partkey * 10 + 1, 'title', 'Spare', 'sku', '', 'price', string(null),
        'compare_at_price', '9.5', 'inventory_quantity', int(null), 'updated_at', string(null))))"""


def _product_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A products file per part: an object with a list, or a bare list."""
    return read(spark, sf, "part").selectExpr(
        f"""if(p_type = 'LARGE', to_json(array({_PRODUCT})),
            to_json(named_struct('products', array({_PRODUCT})))) as text"""
    )


def _product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Products files of the parts of 250 neighbouring keys: objects with a list, and bare lists."""
    pages = (
        read(spark, sf, "part")
        .groupBy(F.expr("floor(p_partkey / 250)"), F.expr("coalesce(p_type = 'LARGE', false)").alias("bare"))
        .agg(F.collect_list(F.expr(_PRODUCT)).alias("products"))
    )
    return pages.selectExpr("if(bare, to_json(products), to_json(struct(products))) as text")


@query(
    "p4_product_variants",
    """select cast(p_partkey * 10 as varchar) as id, cast(p_partkey as varchar) as product_id,
        case when p_size > 25 then p_name else concat(p_name, ' - ', p_brand) end as title,
        cast(p_partkey as varchar) as sku, p_retailprice as price, 0.0::double as compare_at_price,
        p_size as inventory_quantity, '2024-01-01' as updated_at from part
    union all
    select cast(p_partkey * 10 + 1 as varchar), cast(p_partkey as varchar), concat(p_name, ' - Spare'), '',
        0, 9.5, 0, null from part""",
)
def p4(spark, sf):
    return flatten.product_variants(landing.products_from_text(_product_texts(spark, sf), "text"))


@query(
    "p5_cost_seeds",
    """select cast(p_partkey as varchar) as sku,
        case when p_size > 25 then p_name else concat(p_name, ' (', p_brand, ')') end as product_name,
        p_retailprice as original_price, 0.0::double as cogs, 0.0::double as estimated_ad_cost from part""",
)
def p5(spark, sf):
    return flatten.cost_seeds(landing.products_from_text(_product_texts(spark, sf), "text"))


_MONEY = """case when l_returnflag = 'A' then concat('€ ', cast(l_quantity as {text}))
    when l_returnflag = 'N' then concat('-', cast(l_linenumber as {text}), ',50 EUR')
    when l_linestatus = 'O' then case when l_linenumber > 3 then '0' else '1.2.3' end end"""


@query(
    "p9_clean_number",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        case l_returnflag when 'A' then l_quantity when 'N' then -(l_linenumber * 100 + 50) end as marketplace,
        case l_returnflag when 'A' then l_quantity when 'N' then -(l_linenumber * 100 + 50)
             else 0 end::double as webshop
    from lineitem""",
)
def p9(spark, sf):
    rows = read(spark, sf, "lineitem").withColumn("money", F.expr(_MONEY.format(text="string")))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        clean_number(F.col("money"), zero_is_missing=True).alias("marketplace"),
        clean_number(F.col("money"), zero_is_missing=False).alias("webshop"),
    )
