"""Queries: answers from tables that were stored for them, in buckets or as cells."""

from __future__ import annotations

from contextlib import ExitStack
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tillmetrics.catalog.mapping import table
from tillmetrics.catalog.profit import V2_WITH, marketplace_lines, webshop_lines
from tillmetrics.catalog.quality import _SQL_NAMES, _WITH, _row
from tillmetrics.catalog.registry import query, r, xsum
from tillmetrics.catalog.unified import _PRODUCTS_WITH, products
from tillmetrics.fixed import NOT_NULL, RELATIONSHIPS, UNIQUE
from tillmetrics.operators import quality
from tillmetrics.operators.lookups import with_lookups
from tillmetrics.plans import profitability, spans, staging
from tillmetrics.session import scratch_path, staged
from tillmetrics.sinks.bucketed import write_bucketed

BUCKETS = 16


def bucketed(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    name = f"by_{key}_{uuid4().hex}"
    write_bucketed(df, name, key, BUCKETS, scratch_path(spark, name))
    return spark.table(name)


@query("v2_bucketed", V2_WITH + "select * from v2")
def v2_bucketed(spark, sf):
    """Profit per web-shop line from items and orders in equal buckets of the order."""
    return profitability.webshop_profitability(
        staging.webshop_items(bucketed(spark, table(spark, sf, "ws_items"), "order_id")),
        staging.webshop_orders(bucketed(spark, table(spark, sf, "ws_orders"), "order_id")),
        table(spark, sf, "ws_costs"),
        bucketed=True,
    )


_CHILD, _CHILD_KEY, _PARENT, _PARENT_KEY = RELATIONSHIPS[0]


@query(
    "q3_bucketed",
    _WITH
    + _row(
        _CHILD, "relationships", _CHILD_KEY, "count(*)",
        f"{_SQL_NAMES[_CHILD]} k where {_CHILD_KEY} is not null and not exists "
        f"(select 1 from {_SQL_NAMES[_PARENT]} p where p.{_PARENT_KEY} = k.{_CHILD_KEY})",
    ),
)
def q3_bucketed(spark, sf):
    """Items without an order, both tables in equal buckets of the order."""
    child = bucketed(spark, table(spark, sf, _SQL_NAMES[_CHILD]), _CHILD_KEY)
    parent = bucketed(spark, table(spark, sf, _SQL_NAMES[_PARENT]), _PARENT_KEY)
    return quality.relationships(child, _CHILD, _CHILD_KEY, parent, _PARENT_KEY)


_MARTS = {"analytics.bol_profitability": marketplace_lines, "analytics.shopify_profitability": webshop_lines}


def _mart_checks(name: str) -> list[str]:
    given = _SQL_NAMES[name]
    nulls = [_row(name, "not_null", c, f"count(*) - count({c})", given) for c in NOT_NULL[name]]
    twice = [
        _row(name, "unique", c, "count(*)", f"(select {c} from {given} where {c} is not null group by 1 having count(*) > 1)")
        for c in UNIQUE[name]
    ]
    return nulls + twice


@query("q1_checks_while_writing", _WITH + " union all ".join(x for name in _MARTS for x in _mart_checks(name)))
def q1_writing(spark, sf):
    """Both marts, tested as they are stored: NULLs by the writing tasks, uniqueness bucket by bucket."""
    rows = None
    for name, mart in _MARTS.items():
        (key,) = UNIQUE[name]
        stored = f"mart_{uuid4().hex}"
        counts = write_bucketed(
            mart(spark, sf), stored, key, BUCKETS, scratch_path(spark, stored), quality.null_counts(NOT_NULL[name])
        )
        part = quality.not_null_from(spark, name, counts).unionByName(quality.unique(spark.table(stored), name, [key]))
        rows = part if rows is None else rows.unionByName(part)
    return rows


_SPANS = [
    ("all", "1900-01-01", "2100-12-31"),
    ("a year", "1996-01-01", "1996-12-31"),
    ("odd days", "1996-11-05", "1997-06-17"),
    ("a week", "1998-03-30", "1998-04-05"),
    ("a day", "1997-06-17", "1997-06-17"),
    ("none", "1800-01-01", "1800-12-31"),
]
_SPAN_ROWS = ", ".join(f"('{n}', date '{a}', date '{b}')" for n, a, b in _SPANS)


@query(
    "x6_distinct_any_range",
    f"""{_PRODUCTS_WITH}, spans(span, first_day, last_day) as (values {_SPAN_ROWS}),
    dated as (
        select md5(concat_ws('-', ean, 'bol')) as product_key, order_id, cast(order_placed_at as date) as day,
            quantity as units, total_price as revenue from mp_staged
        union all
        select md5(concat_ws('-', i.sku, 'shopify')), i.order_id, cast(h.created_at as date), i.quantity, i.price * i.quantity
        from ws_items i join ws_orders h using (order_id) where i.quantity > 0 and i.price >= 0 and h.total_price >= 0),
    per_span as (
        select span, product_key, count(distinct order_id) as orders, sum(units) as units, {xsum("revenue")} as revenue
        from dated join spans on day between first_day and last_day group by all)
    select span, product_name, sku, channel, cast(sum(orders) as bigint) as total_orders,
        cast(sum(units) as bigint) as units_sold, {r(xsum("revenue"), 2)} as total_revenue
    from per_span join dim using (product_key) group by all""",
)
def x6_any_range(spark, sf):
    """Product performance of several spans of days at once, read from stored cells."""
    marketplace = staging.marketplace_orders(table(spark, sf, "mp_orders")).selectExpr(
        "ean as product_id", "'bol' as channel", "order_id", "date(order_placed_at) as day", "quantity as units",
        "total_price as revenue",
    )
    headers = staging.webshop_orders(table(spark, sf, "ws_orders")).selectExpr("order_id", "date(created_at) as day")
    items = staging.webshop_items(table(spark, sf, "ws_items")).selectExpr(
        "sku as product_id", "'shopify' as channel", "order_id", "quantity as units", "price * quantity as revenue"
    )
    webshop = with_lookups(items, "order_id", headers, how="inner", spread_by=["product_id", "order_id"])
    path = scratch_path(spark, "cells")
    with ExitStack() as kept:
        # What is stored in between lets the shuffles of a step go before the next.
        with staged(marketplace.unionByName(webshop), "lines") as lines:
            days = kept.enter_context(staged(spans.daily_sums(lines), "days"))
        spans.write_cells(spans.cells_of(days), path)
    return spans.performance_between(spark.read.parquet(path), products(spark, sf), _SPANS)
