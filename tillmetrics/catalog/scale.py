"""Queries: hot keys, blank keys, stored marts, files of several shapes, days and clocks."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tillmetrics.catalog.documents import _product_pages
from tillmetrics.catalog.keyed import KEYS, SEQ
from tillmetrics.catalog.mapping import read, table
from tillmetrics.catalog.profit import V1_WITH
from tillmetrics.catalog.registry import SQL, query
from tillmetrics.functions import dates
from tillmetrics.operators import flatten, keyed
from tillmetrics.operators.lookups import with_lookups
from tillmetrics.plans import profitability, staging
from tillmetrics.session import scratch_path
from tillmetrics.sinks import exports
from tillmetrics.sinks.exports import materialize
from tillmetrics.sinks.tables import KeyedTable
from tillmetrics.sources import files, landing


@query(
    "j1_many_hot_keys",
    """select l_orderkey, l_linenumber, l_partkey % 60 as k, n.n_name, r.parts
    from lineitem left join (select n_nationkey, n_name from nation) n on n.n_nationkey = l_partkey % 60
    left join (select if(p_partkey % 7 = 0, -1, p_partkey % 60) as k, count(*) as parts from part group by 1) r
      on r.k = l_partkey % 60""",
)
def j1_hot(spark, sf):
    """Sixty keys hold all lines, each over a two hundredth of them, so all are cut into slices."""
    lines = read(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey % 60 as k")
    names = read(spark, sf, "nation").selectExpr("cast(n_nationkey as bigint) as k", "n_name")
    # A seventh of the parts has a key that no line has.
    parts = read(spark, sf, "part").groupBy(F.expr("if(p_partkey % 7 = 0, -1, p_partkey % 60)").alias("k"))
    return with_lookups(lines, "k", names, parts.agg(F.count(F.lit(1)).alias("parts")), slices=200)


@query("v1_big_lookups", V1_WITH + "select * from v1")
def v1_big(spark, sf):
    """Profit per line with both lookups on the path for large ones."""
    return profitability.marketplace_profitability(
        staging.marketplace_orders(table(spark, sf, "mp_orders")),
        staging.marketplace_offers(table(spark, sf, "mp_offers")),
        table(spark, sf, "mp_costs"),
        slices=32,
    )


_NULLS = "case when l_linenumber = 3 then null else l_orderkey end as l_orderkey, * exclude (l_orderkey)"


@query(
    "k1_null_keys_twice",
    f"""select * from (select {_NULLS} from lineitem)
    qualify row_number() over (partition by l_orderkey, l_linenumber order by {", ".join(f"{c} desc" for c in SEQ)}) = 1""",
)
def k1_nulls(spark, sf):
    """Lines of which some have no order number, loaded twice."""
    lines = read(spark, sf, "lineitem").withColumn("l_orderkey", F.expr("if(l_linenumber = 3, null, l_orderkey)"))
    once = keyed.replace_upsert(lines.filter("false"), lines, KEYS, SEQ)
    return keyed.replace_upsert(once, lines, KEYS, SEQ)


@query(
    "k1_coarse_partition_blank",
    """select o_orderkey, place, o_totalprice from (select *, case o_orderstatus when 'F' then '' when 'O' then null
        else 'a/b=c %' end as place from orders)
    qualify row_number() over (partition by o_orderkey order by o_totalprice desc, place desc nulls last) = 1""",
)
def k1_blank(spark, sf):
    """Two loads into a table whose coarse partition is blank, missing or odd."""
    place = "case o_orderstatus when 'F' then '' when 'O' then null else 'a/b=c %' end as place"
    orders = read(spark, sf, "orders").selectExpr("o_orderkey", place, "o_totalprice")
    schema = "o_orderkey bigint, place string, o_totalprice double"
    stored = KeyedTable(spark, scratch_path(spark, "orders"), schema, ["o_orderkey"], buckets=2, within="place")
    ordered = keyed.last_per_key(orders, ["o_orderkey"], ["o_totalprice", "place"])
    stored.upsert(ordered.filter("o_orderkey % 2 = 0"), ["o_totalprice"])
    stored.upsert(ordered.filter("o_orderkey % 3 <> 0"), ["o_totalprice"])
    stored.upsert(ordered.filter("o_orderkey % 6 = 3"), ["o_totalprice"])
    return stored.read()


@query(
    "k6_blank_keys",
    """select l_orderkey, l_linenumber, cast(l_partkey as varchar) as ean from lineitem
    where l_linestatus = 'O' and l_partkey not in (select p_partkey from part where p_size > 25)""",
)
def k6_blank(spark, sf):
    """Half of the lines have a blank or missing key and go with one blank key in the list."""
    lines = read(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "case when l_linestatus = 'O' then string(l_partkey) when l_linenumber > 3 then '' end as ean",
    )
    listed = read(spark, sf, "part").selectExpr("if(p_size > 25, string(p_partkey), ' ') as ean")
    return keyed.keyed_delete(lines, listed, "ean")


@query("k10_stored_marts", V1_WITH + "select * from v1")
def k10(spark, sf):
    """The staging model as a view, the mart as a stored table, read back by name."""
    view, mart = f"stg_{uuid4().hex}", f"mart_{uuid4().hex}"
    materialize(staging.marketplace_offers(table(spark, sf, "mp_offers")), view, as_table=False)
    lines = profitability.marketplace_profitability(
        staging.marketplace_orders(table(spark, sf, "mp_orders")), spark.table(view), table(spark, sf, "mp_costs")
    )
    materialize(lines, mart, as_table=True, path=scratch_path(spark, mart))
    return spark.table(mart)


@query("s5_product_files", SQL["p4_product_variants"])
def s5(spark, sf):
    """Product files on disk, an object with a list or a bare list of up to 250 products in each."""
    path = scratch_path(spark, "products")
    _product_pages(spark, sf).write.option("maxRecordsPerFile", 1).text(path)
    return flatten.product_variants(landing.products(spark, path))


@query(
    "s6_two_headers",
    """select cast(p_partkey as varchar) as ean, p_name as product_name,
        case when p_size > 25 then p_retailprice end as original_price, cast(p_size as double) as cogs,
        cast(null as double) as estimated_ad_cost from part""",
)
def s6_two(spark, sf):
    """Two cost lists with other columns in another order, read as one."""
    path, part = scratch_path(spark, "lists"), read(spark, sf, "part")
    one = part.filter("p_size <= 25").selectExpr("string(p_partkey) as EAN", "p_name as `Product Name`", "string(p_size) as COGS")
    two = part.filter("p_size > 25").selectExpr(
        "string(p_size) as cogs", "string(p_retailprice) as original_price", "string(p_partkey) as ean", "p_name as product_name"
    )
    one.write.option("header", True).csv(f"{path}/one")
    two.write.option("header", True).csv(f"{path}/two")
    return files.marketplace_costs(spark, f"{path}/*")


@query(
    "s7_two_headers",
    """select cast(p_partkey as varchar) as sku, p_name as product_name,
        case when p_size > 25 then p_retailprice else 0.0::double end as original_price, cast(p_size as double) as cogs,
        0.0::double as estimated_ad_cost from part""",
)
def s7_two(spark, sf):
    """Two web-shop cost lists with other columns in another order, read as one."""
    path, part = scratch_path(spark, "lists"), read(spark, sf, "part")
    one = part.filter("p_size <= 25").selectExpr("string(p_partkey) as SKU", "p_name as `Product Name`", "string(p_size) as COGS")
    two = part.filter("p_size > 25").selectExpr(
        "string(p_size) as cogs", "string(p_retailprice) as originalprice", "string(p_partkey) as sku", "p_name as productname"
    )
    one.write.option("header", True).csv(f"{path}/one")
    two.write.option("header", True).csv(f"{path}/two")
    return files.webshop_costs(spark, f"{path}/*")


@query(
    "s6_wide_list",
    """select cast(p_partkey as varchar) as ean, concat(p_name, ', "', p_brand, '"') as product_name,
        p_retailprice as original_price, cast(p_size as double) as cogs, cast(null as double) as estimated_ad_cost from part""",
)
def s6_wide(spark, sf):
    """A quoted cost list with ninety columns in front of those that count."""
    path = scratch_path(spark, "wide")
    filler = [F.lit(f"x, {i}").alias(f"Note {i}") for i in range(90)]
    rows = read(spark, sf, "part").select(
        *filler,
        F.expr("string(p_partkey) as EAN"),
        F.expr("""concat(p_name, ', "', p_brand, '"') as `Product Name`"""),
        F.expr("string(p_size) as COGS"),
        F.expr("string(p_retailprice) as `Original Price`"),
    )
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return files.marketplace_costs(spark, path)


@query(
    "s8_line_breaks",
    """select concat(p_name, chr(10), '"', p_brand, '", x', chr(10)) as "Product", lpad(cast(p_partkey as varchar), 13, '0') as "EAN",
        cast(p_size as varchar) as "Units_Sold" from part""",
)
def s8_breaks(spark, sf):
    """Names with line breaks and quotes, written and read back by the library."""
    path = scratch_path(spark, "breaks")
    rows = read(spark, sf, "part").selectExpr(
        """concat(p_name, '\n"', p_brand, '", x\n') as Product""", "lpad(string(p_partkey), 13, '0') as EAN",
        "string(p_size) as Units_Sold",
    )
    exports.write_csv(rows, path)
    return files.sales_csv(spark, path)


@query(
    "fn_days_and_clock",
    """select event_id, cast(ts as date) as day,
        cast(timezone('Europe/Amsterdam', timezone('UTC', ts)) as date) as report_day from events""",
)
def days_and_clock(spark, sf):
    """Days written in two forms, and the day in the report's zone at the moment of each event."""
    events = read(spark, sf, "events")
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "M-d-yyyy"))
    return events.select(
        "event_id",
        dates.parse_day(text).alias("day"),
        dates.local_today(now=F.col("ts").cast("timestamp")).alias("report_day"),
    )
