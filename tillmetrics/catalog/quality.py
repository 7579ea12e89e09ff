"""Queries: every declared data test over raw, staged and analytic tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tillmetrics.catalog.mapping import table, with_tables
from tillmetrics.catalog.profit import STAGED_OFFERS, STAGED_ORDERS, V1, V2, marketplace_lines, webshop_lines
from tillmetrics.catalog.registry import query
from tillmetrics.fixed import NOT_NULL, RELATIONSHIPS, UNIQUE
from tillmetrics.operators import quality
from tillmetrics.plans import staging

_RAW = {
    "raw.bol_orders": "mp_orders",
    "raw.bol_offers": "mp_offers",
    "raw.bol_product_costs": "mp_costs",
    "raw.shopify_orders": "ws_orders",
    "raw.shopify_order_items": "ws_items",
    "raw.shopify_product_costs": "ws_costs",
}
_SQL_NAMES = {
    **_RAW,
    "staging.stg_bol_orders": "mp_staged",
    "staging.stg_bol_offers": "of_staged",
    "staging.stg_shopify_orders": "ws_orders_staged",
    "staging.stg_shopify_order_items": "ws_items_staged",
    "analytics.bol_profitability": "v1",
    "analytics.shopify_profitability": "v2",
}
_WITH = with_tables(
    *_RAW.values(),
    more=f"""{STAGED_ORDERS}, {STAGED_OFFERS},
    ws_orders_staged as (select * from ws_orders where order_id is not null and total_price >= 0),
    ws_items_staged as (select * from ws_items where line_item_id is not null and order_id is not null
        and quantity > 0 and price >= 0), {V1}, {V2}""",
)


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    raw = {name: table(spark, sf, source) for name, source in _RAW.items()}
    return {
        **raw,
        "staging.stg_bol_orders": staging.marketplace_orders(raw["raw.bol_orders"]),
        "staging.stg_bol_offers": staging.marketplace_offers(raw["raw.bol_offers"]),
        "staging.stg_shopify_orders": staging.webshop_orders(raw["raw.shopify_orders"]),
        "staging.stg_shopify_order_items": staging.webshop_items(raw["raw.shopify_order_items"]),
        "analytics.bol_profitability": marketplace_lines(spark, sf),
        "analytics.shopify_profitability": webshop_lines(spark, sf),
    }


def _row(name: str, test: str, column: str, failures: str, source: str) -> str:
    return (
        f"select '{name}' as table_name, '{test}' as test, '{column}' as column_name, "
        f"cast({failures} as bigint) as failures from {source}"
    )


_NOT_NULL_SQL = " union all ".join(
    _row(t, "not_null", c, f"count(*) - count({c})", _SQL_NAMES[t]) for t, cols in NOT_NULL.items() for c in cols
)
_UNIQUE_SQL = " union all ".join(
    _row(t, "unique", c, "count(*)", f"(select {c} from {_SQL_NAMES[t]} where {c} is not null group by 1 having count(*) > 1)")
    for t, cols in UNIQUE.items()
    for c in cols
)
_RELATED_SQL = " union all ".join(
    _row(
        t, "relationships", c, "count(*)",
        f"{_SQL_NAMES[t]} k where {c} is not null and not exists (select 1 from {_SQL_NAMES[p]} p where p.{pc} = k.{c})",
    )
    for t, c, p, pc in RELATIONSHIPS
)


@query("q1_not_null", _WITH + _NOT_NULL_SQL)
def q1(spark, sf):
    given = tables(spark, sf)
    return reduce(DataFrame.unionByName, [quality.not_null(given[t], t, cols) for t, cols in NOT_NULL.items()])


@query("q2_unique", _WITH + _UNIQUE_SQL)
def q2(spark, sf):
    given = tables(spark, sf)
    parts = [quality.unique(given[t], t, [c]) for t, cols in UNIQUE.items() for c in cols]
    return reduce(DataFrame.unionByName, parts)


@query(
    "q2_unique_order_key",
    _WITH
    + _row(
        "raw.bol_orders", "unique", "order_id, order_item_id", "count(*)",
        "(select 1 from mp_orders group by order_id, order_item_id having count(*) > 1)",
    ),
)
def q2_key(spark, sf):
    return quality.unique(table(spark, sf, "mp_orders"), "raw.bol_orders", ["order_id", "order_item_id"])


@query("q3_relationships", _WITH + _RELATED_SQL)
def q3(spark, sf):
    given = tables(spark, sf)
    parts = [quality.relationships(given[t], t, c, given[p], pc) for t, c, p, pc in RELATIONSHIPS]
    return reduce(DataFrame.unionByName, parts)


@query(
    "q3_orphans",
    with_tables("ws_items", "mp_offers")
    + _row("items", "relationships", "sku", "count(*)", "ws_items k where not exists (select 1 from mp_offers p where p.ean = k.sku)"),
)
def q3_orphans(spark, sf):
    return quality.relationships(table(spark, sf, "ws_items"), "items", "sku", table(spark, sf, "mp_offers"), "ean")
