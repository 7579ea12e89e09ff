"""Profit per order line for each channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillmetrics.fixed import AFFILIATE_RATE, VAT_DIVISOR
from tillmetrics.functions.num import select_rounded
from tillmetrics.operators.keyed import first_per_key
from tillmetrics.operators.lookups import with_lookups


def marketplace_profitability(
    orders: DataFrame,
    offers: DataFrame,
    costs: DataFrame,
    after_commission: bool = True,
    dedupe_offers: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Margin, revenue and profit of every marketplace order line.

    Offers join by EAN, so a line repeats once per offer of its EAN. With
    ``dedupe_offers`` an EAN has one offer, the one with the smallest id.
    ``after_commission=False`` gives the variant whose margin ignores the
    commission and whose original price is the offer price. ``slices``: as in
    ``with_lookups``.
    """
    if dedupe_offers:
        offers = first_per_key(offers, ["ean"], F.col("offer_id"))
    lines = with_lookups(
        orders,
        "ean",
        offers.selectExpr("ean", "unit_price as _offer_price"),
        costs.selectExpr(
            "ean", "original_price as _listed_price", "cogs as _cogs", "estimated_ad_cost as _ad_cost"
        ),
        spread_by=["order_id", "order_item_id"],
        slices=slices,
    )
    # a manual price entry comes before the price of the offer
    original = "coalesce(nullif(_listed_price, 0D), _offer_price)" if after_commission else "_offer_price"
    commission = "bol_commission" if after_commission else "commission"
    priced = lines.selectExpr(
        "order_id",
        "order_item_id",
        "order_placed_at as date",
        "title as product_name",
        "ean",
        "quantity as units_sold",
        "unit_price as selling_price",
        f"commission as {commission}",
        f"{original} as original_price",
        "coalesce(_cogs, 0D) as cogs",
        "coalesce(_ad_cost, 0D) as estimated_ad_cost",
        f"unit_price / {VAT_DIVISOR}D as _net",
    )
    margin = "_net - cogs - estimated_ad_cost" + (f" - {commission}" if after_commission else "")
    return select_rounded(
        priced.selectExpr("*", f"{margin} as _margin"),
        [
            "order_id", "order_item_id", "date", "product_name", "ean", "units_sold", "selling_price",
            commission, "original_price", "cogs", "estimated_ad_cost",
            "cogs * units_sold as cogs_total",
            "selling_price * units_sold as revenue",
        ],
        {
            "net_selling_price": ("_net", 2),
            "discount_used_pct": (
                "if(original_price > 0, (original_price - selling_price) / nullif(original_price, 0D) * 100, 0D)",
                1,
            ),
            "net_margin_eur": ("_margin", 2),
            "net_margin_pct": ("if(selling_price > 0, _margin / nullif(_net, 0D) * 100, 0D)", 1),
            "profit": ("_margin * units_sold", 2),
        },
    )


def webshop_profitability(
    items: DataFrame, orders: DataFrame, costs: DataFrame, listed_name: bool = True, bucketed: bool = False
) -> DataFrame:
    """Margin, revenue and profit of every web-shop line item.

    The affiliate fee applies to orders that came through a landing site. Ad
    cost is shown but not part of the margin. ``listed_name=False`` names a product
    as the order line does, whatever the cost list says. ``bucketed``: items and
    orders are tables in equal buckets of order_id (``sinks.bucketed``); they are
    merged bucket by bucket, without a shuffle.
    """
    ordered = items.select("order_id", "line_item_id", "sku", "name", "quantity", "price", "total_discount")
    headers = orders.selectExpr("order_id", "created_at as date", "landing_site is not null as _referred")
    if bucketed:
        lines = ordered.join(headers.hint("merge"), "order_id")
    else:
        lines = with_lookups(ordered, "order_id", headers, how="inner", spread_by=["line_item_id"])
    lines = with_lookups(
        lines,
        "sku",
        costs.selectExpr(
            "sku", "product_name as _listed_name", "original_price as _listed_price",
            "cogs as _cogs", "estimated_ad_cost as _ad_cost",
        ),
        spread_by=["line_item_id", "order_id"],
        counts_from=items,
    )
    base = lines.selectExpr(
        "order_id",
        "line_item_id",
        "date",
        "_referred",
        ("coalesce(_listed_name, name)" if listed_name else "name") + " as product_name",
        "sku",
        "quantity as units_sold",
        "(price * quantity - total_discount) / nullif(quantity, 0) as selling_price",
        "coalesce(_listed_price, price) as original_price",
        "coalesce(_cogs, 0D) as cogs",
        "coalesce(_ad_cost, 0D) as estimated_ad_cost",
    )
    margined = base.selectExpr(
        "*",
        f"selling_price / {VAT_DIVISOR}D - cogs - if(_referred, selling_price * {AFFILIATE_RATE}D, 0D) as _margin",
    )
    rounded = select_rounded(
        margined,
        [
            "order_id", "line_item_id", "date", "product_name", "sku", "units_sold", "selling_price",
            "original_price", "cogs", "estimated_ad_cost",
            "cogs * units_sold as cogs_total",
            "selling_price * units_sold as revenue",
        ],
        {
            "shopify_affiliate_fee": (f"if(_referred, selling_price * {AFFILIATE_RATE}D, 0D)", 2),
            "net_selling_price": (f"selling_price / {VAT_DIVISOR}D", 2),
            # a share with three digits, shown as a percentage below
            "discount_used_pct": (
                "if(original_price > 0, (original_price - selling_price) / nullif(original_price, 0D), 0D)",
                3,
            ),
            "net_margin_eur": ("_margin", 2),
            "profit": ("_margin * units_sold", 2),
        },
    )
    return rounded.withColumn("discount_used_pct", F.col("discount_used_pct") * 100)
