"""The benchmark tables seen as the raw tables of the two channels.

Every logical table exists twice, as a DataFrame and as SQL text, so that a
query and its check start from the same rows. Some offers and costs have a key
that no order line has, so that lookups also miss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REFERENCE_DAY = "2024-01-17"


_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A benchmark table; the schema is given, so no file is opened to plan a query."""
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


_TABLES: dict[str, tuple[str, str]] = {
    # name: (benchmark table, select list and filter understood by both engines)
    "mp_orders": ("lineitem", """
        select cast(l_orderkey as string) as order_id,
               concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as order_item_id,
               cast(cast(l_shipdate as date) as string) as order_placed_at,
               case when l_linestatus = 'O' then 'FBR' else 'FBB' end as fulfillment_method,
               cast(l_partkey as string) as ean,
               concat('Part ', cast(l_partkey as string)) as title,
               cast(l_quantity as int) as quantity,
               l_extendedprice / nullif(l_quantity, 0) as unit_price,
               l_extendedprice as total_price,
               l_extendedprice / nullif(l_quantity, 0) * nullif(l_tax, 0) as commission
        from lineitem"""),
    "mp_offers": ("part", """
        select concat('OF-', cast(p_partkey as string)) as offer_id,
               case when p_type = 'SMALL' then concat('none-', cast(p_partkey as string))
                    else cast(p_partkey as string) end as ean,
               p_name as product_title,
               p_size as stock_amount,
               p_size as corrected_stock,
               p_type = 'LARGE' as managed_by_retailer,
               p_retailprice * cast(1.1 as double) as unit_price,
               'FBR' as fulfillment_method,
               '24uurs-23' as delivery_code
        from part"""),
    "mp_costs": ("part", """
        select case when p_type = 'ECONOMY' then concat('none-', cast(p_partkey as string))
                    else cast(p_partkey as string) end as ean,
               case when p_type = 'MEDIUM' then '' else p_name end as product_name,
               case when p_size <= 16 then cast(0 as double)
                    else p_retailprice * cast(1.3 as double) end as original_price,
               p_retailprice * cast(0.4 as double) as cogs,
               p_size * cast(0.1 as double) as estimated_ad_cost
        from part"""),
    "ws_orders": ("orders", """
        select cast(o_orderkey as string) as order_id,
               o_orderdate as created_at,
               o_totalprice as total_price,
               o_totalprice / cast(1.21 as double) as subtotal_price,
               o_totalprice - o_totalprice / cast(1.21 as double) as total_tax,
               'EUR' as currency,
               case when o_orderpriority in ('1-URGENT', '2-HIGH') then '/ref/partner' end as landing_site
        from orders"""),
    "ws_items": ("lineitem", """
        select cast(l_orderkey as string) as order_id,
               concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as line_item_id,
               cast(l_partkey as string) as sku,
               concat('Part ', cast(l_partkey as string)) as name,
               cast(l_quantity as int) as quantity,
               l_extendedprice / nullif(l_quantity, 0) as price,
               l_extendedprice * nullif(l_discount, cast(0.1 as double)) as total_discount
        from lineitem"""),
    "ws_costs": ("part", """
        select case when p_type = 'ECONOMY' then concat('none-', cast(p_partkey as string))
                    else cast(p_partkey as string) end as sku,
               case when p_type = 'MEDIUM' then null else p_name end as product_name,
               case when p_size <= 16 then cast(0 as double)
                    else p_retailprice * cast(1.3 as double) end as original_price,
               p_retailprice * cast(0.4 as double) as cogs,
               p_size * cast(0.1 as double) as estimated_ad_cost
        from part"""),
    # conversion side: views are visits, purchases are orders, the user is the offer
    "cv_orders": ("events", """
        select cast(event_id as string) as order_id,
               cast(event_id as string) as order_item_id,
               cast(ts as string) as order_placed_at,
               cast(user_id as string) as ean,
               cast(floor(value / 100) as int) + 1 as quantity
        from events where event_type = 'purchase'"""),
    "cv_views": ("events", """
        select concat('OF-', cast(user_id as string)) as offer_id,
               cast(ts as date) as day,
               case when value < 150 then 'NL' when value < 300 then 'BE' else 'DE' end as country
        from events where event_type = 'view'"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, text = _TABLES[name]
    return spark.sql(text.replace(f"from {base}", "from {src}"), src=read(spark, sf_dir, base))


def with_tables(*names: str, more: str = "") -> str:
    """WITH clause holding the named logical tables, then ``more`` clauses."""
    parts = [f"{n} as ({_TABLES[n][1].replace(' as string', ' as varchar')})" for n in names]
    if more:
        parts.append(more)
    return "with " + ",\n".join(parts) + "\n"
