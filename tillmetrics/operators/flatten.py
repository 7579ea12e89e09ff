"""Landed JSON documents to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.fixed import SINGLE_VARIANT_TITLE


def _money(text: Column) -> Column:
    """Number, or 0 when missing or empty."""
    return F.coalesce(F.nullif(F.trim(text.cast("string")), F.lit("")).cast("double"), F.lit(0.0))


def order_items(documents: DataFrame) -> DataFrame:
    """One row per item of each marketplace order document."""
    carried = [c for c in documents.columns if c not in ("orderId", "orderPlacedDateTime", "orderItems")]
    return documents.select(
        "orderId", "orderPlacedDateTime", *carried, F.posexplode("orderItems").alias("item_pos", "item")
    ).select(
        F.col("orderId").alias("order_id"),
        F.col("item.orderItemId").alias("order_item_id"),
        F.col("orderPlacedDateTime").alias("order_placed_at"),
        F.col("item.fulfilment.method").alias("fulfillment_method"),
        F.col("item.product.ean").alias("ean"),
        F.col("item.product.title").alias("title"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.unitPrice").alias("unit_price"),
        F.col("item.totalPrice").alias("total_price"),
        F.col("item.commission").alias("commission"),
        *carried,
        "item_pos",
    )


def offers(pages: DataFrame) -> DataFrame:
    """One row per offer; the price of the first bundle, stock 0 when absent."""
    return pages.select(F.explode("offers").alias("offer")).select(
        F.col("offer.offerId").alias("offer_id"),
        F.col("offer.ean").alias("ean"),
        F.col("offer.unknownProductTitle").alias("product_title"),
        F.coalesce("offer.stock.amount", F.lit(0)).alias("stock_amount"),
        F.coalesce("offer.stock.correctedStock", F.lit(0)).alias("corrected_stock"),
        F.coalesce("offer.stock.managedByRetailer", F.lit(False)).alias("managed_by_retailer"),
        F.get("offer.pricing.bundlePrices", 0)["unitPrice"].alias("unit_price"),
        F.col("offer.fulfilment.method").alias("fulfillment_method"),
        F.col("offer.fulfilment.deliveryCode").alias("delivery_code"),
    )


def webshop_order_headers(orders: DataFrame) -> DataFrame:
    """Typed order headers of the web shop."""
    return orders.select(
        F.col("id").cast("string").alias("order_id"),
        "created_at",
        _money(F.col("total_price")).alias("total_price"),
        _money(F.col("subtotal_price")).alias("subtotal_price"),
        _money(F.col("total_tax")).alias("total_tax"),
        "currency",
        "landing_site",
    )


def webshop_line_items(orders: DataFrame) -> DataFrame:
    """One row per line item, with its order's landing site and date."""
    return orders.select(
        F.col("id").cast("string").alias("order_id"), "landing_site", "created_at",
        F.explode("line_items").alias("line"),
    ).select(
        "order_id",
        F.col("line.id").cast("string").alias("line_item_id"),
        F.col("line.sku").alias("sku"),
        F.col("line.name").alias("name"),
        F.col("line.quantity").alias("quantity"),
        _money(F.col("line.price")).alias("price"),
        _money(F.col("line.total_discount")).alias("total_discount"),
        "landing_site",
        "created_at",
    )


def _variant_rows(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("id").cast("string").alias("product_id"), F.col("title").alias("product_title"),
        F.explode("variants").alias("v"),
    )


def _variant_name(open_mark: str, close_mark: str, missing: str) -> Column:
    """Product title, with the variant title unless it is the single default one."""
    title = F.coalesce(F.col("v.title"), F.lit(missing))
    product = F.coalesce(F.col("product_title"), F.lit(missing))
    return F.when(
        title != SINGLE_VARIANT_TITLE, F.concat(product, F.lit(open_mark), title, F.lit(close_mark))
    ).otherwise(F.col("product_title"))


def product_variants(products: DataFrame) -> DataFrame:
    """One row per variant, titled ``Product - Variant``."""
    return _variant_rows(products).select(
        F.col("v.id").cast("string").alias("id"),
        "product_id",
        _variant_name(" - ", "", "None").alias("title"),
        F.col("v.sku").alias("sku"),
        _money(F.col("v.price")).alias("price"),
        _money(F.col("v.compare_at_price")).alias("compare_at_price"),
        F.coalesce("v.inventory_quantity", F.lit(0)).alias("inventory_quantity"),
        F.col("v.updated_at").alias("updated_at"),
    )


def cost_seeds(products: DataFrame) -> DataFrame:
    """Web-shop cost rows to fill in by hand, named ``Product (Variant)``; no sku, no row."""
    return (
        _variant_rows(products)
        .filter(F.coalesce(F.col("v.sku"), F.lit("")) != "")
        .select(
            F.col("v.sku").alias("sku"),
            _variant_name(" (", ")", "").alias("product_name"),
            _money(F.col("v.price")).alias("original_price"),
            F.lit(0.0).alias("cogs"),
            F.lit(0.0).alias("estimated_ad_cost"),
        )
    )
