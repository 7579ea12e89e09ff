"""Typed and validity-filtered views of the raw tables, one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillmetrics.functions.dates import written_between


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def marketplace_orders(raw: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Keys given, quantity and price above zero, order moment as a timestamp.

    ``start``, ``end``: the first and last day of interest, where the raw moments are
    ISO texts. They spare the scan of other days and are no exact filter.
    """
    if start is not None or end is not None:
        raw = raw.filter(written_between(F.col("order_placed_at"), start, end))
    columns = _present(raw, [
        "order_id", "order_item_id", "order_placed_at", "fulfillment_method", "ean", "title",
        "quantity", "unit_price", "total_price", "commission", "fetched_at",
    ])
    return (
        raw.filter("order_id is not null and order_item_id is not null")
        .filter("quantity > 0 and unit_price > 0")
        .select(*columns)
        .withColumn("order_placed_at", F.col("order_placed_at").try_cast("timestamp_ntz"))
    )


def marketplace_offers(raw: DataFrame) -> DataFrame:
    columns = _present(raw, [
        "offer_id", "ean", "product_title", "stock_amount", "corrected_stock",
        "managed_by_retailer", "unit_price", "fulfillment_method", "delivery_code", "fetched_at",
    ])
    return raw.filter("offer_id is not null and ean is not null").select(*columns)


def webshop_orders(raw: DataFrame) -> DataFrame:
    columns = _present(raw, [
        "order_id", "created_at", "total_price", "subtotal_price", "total_tax", "currency",
        "landing_site", "fetched_at",
    ])
    return raw.filter("order_id is not null and total_price >= 0").select(*columns)


def webshop_items(raw: DataFrame) -> DataFrame:
    columns = _present(raw, [
        "line_item_id", "order_id", "sku", "name", "quantity", "price", "total_discount", "fetched_at",
    ])
    return raw.filter(
        "line_item_id is not null and order_id is not null and quantity > 0 and price >= 0"
    ).select(*columns)
