"""Product and week rollups of profitability lines.

All measures combine before the shuffle (longs and maxima only), so a product
that holds a third of the lines costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillmetrics.fixed import VAT_DIVISOR
from tillmetrics.functions.dates import iso_week, week_end
from tillmetrics.operators.exact import Measure, exact_agg, mean, total


def _product_key(lines: DataFrame) -> str:
    """EAN for marketplace lines, SKU for web-shop lines."""
    return "ean" if "ean" in lines.columns else "sku"


def _measures(lines: DataFrame, with_ad_cost: bool) -> dict[str, Measure]:
    """Averages and totals of a rollup. Web-shop lines carry no margin
    percentage, so theirs is derived from the margin and the net price."""
    if "net_margin_pct" in lines.columns:
        margin_pct = mean("net_margin_pct", 1, stored=1)
    else:
        margin_pct = mean(f"net_margin_eur / nullif(selling_price / {VAT_DIVISOR}D, 0D)", 1, times=100)
    return {
        "avg_cogs": mean("cogs"),
        **({"avg_ad_cost": mean("estimated_ad_cost")} if with_ad_cost else {}),
        "avg_selling_price": mean("selling_price"),
        "avg_original_price": mean("original_price"),
        "avg_discount_pct": mean("discount_used_pct", 1, stored=1),
        "avg_net_margin": mean("net_margin_eur", stored=2),
        "avg_margin_pct": margin_pct,
        "total_revenue": total("revenue"),
        "total_profit": total("profit", stored=2),
    }


def product_summary(lines: DataFrame) -> DataFrame:
    """Per product: latest order, units, averages, revenue and profit."""
    return exact_agg(
        lines,
        ["product_name", _product_key(lines)],
        {"latest_order": "max(date)", "total_units": "sum(units_sold)"},
        _measures(lines, with_ad_cost=False),
    )


def newest_first(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("latest_order").desc_nulls_last(), F.col("product_name").asc_nulls_last())


def grand_total(summary: DataFrame) -> DataFrame:
    """Units, revenue and profit over all product rows."""
    return exact_agg(
        summary,
        [],
        {"total_units": "coalesce(sum(total_units), 0)"},
        {"total_revenue": total("total_revenue", stored=2), "total_profit": total("total_profit", stored=2)},
    ).na.fill(0.0)


def weekly_rollup(lines: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Per Monday-to-Sunday week and product; dates inclusive."""
    key = _product_key(lines)
    dated = lines.withColumn("date", F.col("date").cast("date"))
    if start is not None:
        dated = dated.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        dated = dated.filter(F.col("date") <= F.lit(end).cast("date"))
    rolled = exact_agg(
        dated.withColumn("week_start", F.trunc("date", "week")),
        ["week_start", "product_name", key],
        {"latest_order": "max(date)", "total_units": "sum(units_sold)"},
        _measures(lines, with_ad_cost=True),
    )
    monday = F.col("week_start")
    return rolled.select(
        "week_start",
        week_end(monday).alias("week_end"),
        iso_week(monday).alias("iso_week"),
        *[c for c in rolled.columns if c != "week_start"],
    )


def by_week_and_revenue(rollup: DataFrame) -> DataFrame:
    return rollup.orderBy(
        F.col("week_start").asc_nulls_last(),
        F.col("total_revenue").desc_nulls_last(),
        F.col("product_name").asc_nulls_last(),
    )
