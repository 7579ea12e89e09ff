"""Queries: upserts, merges, deletes, history, incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics import schemas
from tillmetrics.catalog.conversion import metrics, metrics_sql
from tillmetrics.catalog.mapping import read, table, with_tables
from tillmetrics.catalog.registry import query
from tillmetrics.operators import keyed, scd
from tillmetrics.plans import loads
from tillmetrics.session import scratch_path
from tillmetrics.sinks.tables import KeyedTable

KEYS = ["l_orderkey", "l_linenumber"]
SEQ = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
_SEQ_DESC = ", ".join(f"{c} desc" for c in SEQ)
_LAST = f"row_number() over (partition by l_orderkey, l_linenumber order by {_SEQ_DESC}) = 1"
_OLD = f"old as (select * from lineitem where l_returnflag <> 'N' qualify {_LAST})"
_NEW = f"new as (select * from lineitem where l_returnflag = 'N' qualify {_LAST})"
_REPLACED = f"""with {_OLD}, {_NEW}
    select * from new union all
    select o.* from old o anti join new n on o.l_orderkey = n.l_orderkey and o.l_linenumber = n.l_linenumber"""


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = read(spark, sf, "lineitem")
    return lines.filter("l_returnflag <> 'N'"), lines.filter("l_returnflag = 'N'")


@query("k1_replace_upsert", _REPLACED)
def k1(spark, sf):
    first, second = _batches(spark, sf)
    return keyed.replace_upsert(keyed.last_per_key(first, KEYS, SEQ), second, KEYS, SEQ)


@query("k1_stored_table", _REPLACED)
def k1_table(spark, sf):
    """Two loads into a stored table, the second one repeated: a repeat changes nothing."""
    first, second = _batches(spark, sf)
    stored = KeyedTable(
        spark, scratch_path(spark, "lines"), first._jdf.schema().toDDL().replace(" NOT NULL", ""), KEYS, buckets=8
    )
    for batch in (first, second, second):
        stored.upsert(batch, SEQ)
    return stored.read()


def _lines_table(spark: SparkSession, sf: str, name: str, **options) -> KeyedTable:
    ddl = read(spark, sf, "lineitem")._jdf.schema().toDDL().replace(" NOT NULL", "")
    return KeyedTable(spark, scratch_path(spark, name), ddl, KEYS, **options)


@query("k1_growing_table", f"select * from lineitem qualify {_LAST}")
def k1_growing(spark, sf):
    """A first load of one key, then all lines, then one key again: buckets split as the table grows."""
    lines = read(spark, sf, "lineitem")
    stored = _lines_table(spark, sf, "growing", rows_per_bucket=5_000)
    one = lines.filter("l_orderkey = 1")
    for batch in (one, lines, one):
        stored.upsert(batch, SEQ, keep_newer=True)
    return stored.read()


@query("k1_changed_part", _REPLACED)
def k1_changed(spark, sf):
    """Lines lie by year of shipping; a line that comes again with another year leaves the old one."""
    stored = _lines_table(spark, sf, "years", within="year(l_shipdate)", rows_per_bucket=20_000)
    for batch in _batches(spark, sf):
        stored.upsert(batch, SEQ)
    return stored.read()


@query(
    "k2_metrics_table",
    with_tables(
        "mp_offers", "mp_costs", "cv_orders", "cv_views",
        more=metrics_sql(["2024-01-17", "2024-01-24"]),
    )
    + "select * from metrics",
)
def k2(spark, sf):
    stored = KeyedTable(
        spark, scratch_path(spark, "metrics"), schemas.CONVERSION,
        ["offer_id", "period_type", "period_label"], buckets=4,
    )
    for day in ("2024-01-17", "2024-01-24"):
        rows = metrics(spark, sf, "both", day).withColumn("fetched_at", F.lit(None).cast("timestamp_ntz"))
        stored.upsert(rows, ["date"])
    return stored.read().drop("fetched_at")


@query(
    "k3_upsert_some_columns",
    f"""with {_OLD}, {_NEW}
    select coalesce(o.l_orderkey, n.l_orderkey) as l_orderkey, coalesce(o.l_linenumber, n.l_linenumber) as l_linenumber,
        case when n.l_orderkey is not null then n.l_quantity else o.l_quantity end as l_quantity,
        case when n.l_orderkey is not null then n.l_extendedprice else o.l_extendedprice end as l_extendedprice,
        case when o.l_orderkey is not null then o.l_partkey else n.l_partkey end as l_partkey,
        case when o.l_orderkey is not null then o.l_returnflag else n.l_returnflag end as l_returnflag,
        case when o.l_orderkey is not null then o.l_shipdate else n.l_shipdate end as l_shipdate
    from old o full join new n on o.l_orderkey = n.l_orderkey and o.l_linenumber = n.l_linenumber""",
)
def k3(spark, sf):
    first, second = _batches(spark, sf)
    merged = keyed.replace_upsert(
        keyed.last_per_key(first, KEYS, SEQ), second, KEYS, SEQ, ["l_quantity", "l_extendedprice"]
    )
    return merged.select(*KEYS, "l_quantity", "l_extendedprice", "l_partkey", "l_returnflag", "l_shipdate")


# cost changes: one per order line, with blanks and gaps
_CHANGES = """changes as (
    select cast(l_partkey as string) as ean,
        case l_returnflag when 'A' then '' when 'R' then concat('Supplier ', cast(l_suppkey as string)) end as product_name,
        case when l_linestatus = 'O' then l_extendedprice end as original_price,
        nullif(l_tax, cast(0 as double)) * 100 as cogs,
        case when l_discount > cast(0.05 as double) then l_discount end as estimated_ad_cost,
        l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice
    from lineitem)"""
_CHANGE_SEQ = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
_BY = "order by " + ", ".join(_CHANGE_SEQ)


def changes(spark: SparkSession, sf: str) -> DataFrame:
    inner = _CHANGES[len("changes as (") : -1].replace("from lineitem", "from {src}")
    return spark.sql(inner, src=read(spark, sf, "lineitem"))


_MERGED = f"""{with_tables("mp_costs", more=_CHANGES.replace(" as string", " as varchar"))},
    c as (select ean,
            last(product_name {_BY}) filter (product_name <> '') as name,
            first(product_name {_BY}) as first_name,
            last(original_price {_BY}) filter (original_price is not null) as original_price,
            last(cogs {_BY}) filter (cogs is not null) as cogs,
            last(estimated_ad_cost {_BY}) filter (estimated_ad_cost is not null) as estimated_ad_cost
          from changes group by ean)
    select coalesce(o.ean, c.ean) as ean,
        coalesce(c.name, case when o.ean is not null then o.product_name else c.first_name end) as product_name,
        coalesce(c.original_price, o.original_price) as original_price,
        coalesce(c.cogs, o.cogs) as cogs,
        coalesce(c.estimated_ad_cost, o.estimated_ad_cost) as estimated_ad_cost
    from mp_costs o full join c on o.ean = c.ean"""


@query("k4_conditional_merge", _MERGED)
def k4(spark, sf):
    return keyed.conditional_merge(table(spark, sf, "mp_costs"), changes(spark, sf), "ean", _CHANGE_SEQ)


@query("k4_stored_costs", _MERGED)
def k4_table(spark, sf):
    """The stored twin: old costs are merged into an empty table, then the changes."""
    stored = KeyedTable(spark, scratch_path(spark, "costs"), schemas.MARKETPLACE_COSTS, ["ean"], buckets=8)
    stored.merge_costs(table(spark, sf, "mp_costs"), ["ean"])
    stored.merge_costs(changes(spark, sf), _CHANGE_SEQ)
    return stored.read().drop("updated_at")


@query(
    "k5_set_cost",
    with_tables("mp_costs")
    + """select coalesce(o.ean, c.ean) as ean, coalesce(o.product_name, '') as product_name, o.original_price,
        coalesce(c.cogs, o.cogs) as cogs, coalesce(c.ad, o.estimated_ad_cost) as estimated_ad_cost
    from mp_costs o full join (
        select cast(p_partkey as varchar) as ean, case when p_size > 10 then p_retailprice / 2 end as cogs,
               cast(p_size as double) as ad from part where p_type in ('LARGE', 'ECONOMY')) c on o.ean = c.ean""",
)
def k5(spark, sf):
    new = read(spark, sf, "part").filter("p_type in ('LARGE', 'ECONOMY')").selectExpr(
        "string(p_partkey) as ean", "if(p_size > 10, p_retailprice / 2, null) as cogs",
        "double(p_size) as estimated_ad_cost",
    )
    return loads.set_costs(table(spark, sf, "mp_costs"), new, "ean")


_BLANK_KEYS = "case p_type when 'MEDIUM' then '' when 'STANDARD' then null else cast(p_partkey as varchar) end as ean"


@query(
    "k6_keyed_delete",
    f"""select * from (select {_BLANK_KEYS}, p_name, p_retailprice, p_size, p_type from part)
    where coalesce(ean, '') <> '' and p_type <> 'LARGE'""",
)
def k6(spark, sf):
    part = read(spark, sf, "part")
    costs = part.selectExpr(_BLANK_KEYS.replace("varchar", "string"), "p_name", "p_retailprice", "p_size", "p_type")
    listed = part.filter("p_type in ('LARGE', 'PROMO')").selectExpr(
        "if(p_type = 'PROMO', ' ', string(p_partkey)) as ean"
    )
    return keyed.keyed_delete(costs, listed, "ean")


@query(
    "j11_anti_join",
    """select cast(p_partkey as varchar) as sku, p_name from part
    where p_partkey not in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity > 45)""",
)
def j11(spark, sf):
    sold = read(spark, sf, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").selectExpr(
        "string(l_partkey) as sku"
    )
    return keyed.keyed_delete(
        read(spark, sf, "part").selectExpr("string(p_partkey) as sku", "p_name"), sold, "sku"
    )


_SNAPSHOTS = [
    ("2024-01-01", "p_type <> 'PROMO'", "p_retailprice"),
    ("2024-02-01", "p_type <> 'SMALL'", "case when p_size > 25 then p_retailprice + 10 else p_retailprice end"),
    ("2024-03-01", "true", "case when p_size > 40 then p_retailprice + 10 else p_retailprice end"),
]


@query(
    "x7_price_history",
    "with s as ("
    + " union all ".join(
        f"select timestamp '{at}' as moment, p_partkey as product_id, p_name as product_name, {price} as price from part where {keep}"
        for at, keep, price in _SNAPSHOTS
    )
    + """), c as (select *, lag(price) over w as before, row_number() over w as n from s
         window w as (partition by product_id order by moment)),
    k as (select * from c where n = 1 or price <> before)
    select product_id, product_name, price, moment as valid_from,
        lead(moment) over (partition by product_id order by moment) as valid_to from k""",
)
def x7(spark, sf):
    history = None
    for at, keep, price in _SNAPSHOTS:
        snapshot = read(spark, sf, "part").filter(keep).selectExpr(
            "p_partkey as product_id", "p_name as product_name", f"{price} as price"
        )
        moment = F.lit(at).cast("timestamp_ntz")
        if history is None:
            history = scd.start_history(snapshot, moment)
        else:
            history = scd.apply_snapshot(history, snapshot, "product_id", ["price"], moment)
    return history


@query("x8_incremental_rows", "select * from events where ts > (select max(ts) from events where ts < timestamp '2024-01-15')")
def x8(spark, sf):
    source = read(spark, sf, "events")
    return loads.rows_after(source, source.filter("ts < timestamp_ntz '2024-01-15'"), "ts")


@query("x8_full_then_append", "select * from events")
def x8_files(spark, sf):
    source, path = read(spark, sf, "events"), scratch_path(spark, "events")
    loads.full_load(source.filter("ts < timestamp_ntz '2024-01-15'"), path)
    loaded = spark.read.schema(source.schema).parquet(path)
    loads.append_load(loads.rows_after(source, loaded, "ts"), path)
    return spark.read.schema(source.schema).parquet(path)


@query("o5_cost_listing", with_tables("mp_costs") + "select * from mp_costs")
def o5(spark, sf):
    return loads.cost_listing(table(spark, sf, "mp_costs"), "ean")
