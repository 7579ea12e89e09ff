"""Dashboard numbers over the normalized sales view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.functions.num import select_rounded
from tillmetrics.operators.exact import exact_agg, mean, total


def headline(sales: DataFrame, discount_share: bool = True) -> DataFrame:
    """Totals, weekly averages, mean margin and discount rate in one pass.

    The discount rate is the share of discounted rows (marketplace) or, with
    ``discount_share=False``, the mean discount in percent (web shop).
    """
    rate = "if(discount_applied, 100D, 0D)" if discount_share else "discount_used_pct"
    totals = exact_agg(
        sales,
        [],
        {"week_count": "greatest(count(distinct week_number), 1)"},
        {
            "total_units": total("units_sold", None),
            "_revenue": total("revenue", None),
            "_revenue_ex": total("revenue_ex_vat", None, stored=2),
            "avg_margin_pct": mean("net_margin_pct", 1),
            "discount_rate": mean(rate, 1),
        },
    ).na.fill(0.0)
    return select_rounded(
        totals,
        ["total_units", "week_count", "avg_margin_pct", "discount_rate"],
        {
            "total_revenue": ("_revenue", 2),
            "total_revenue_ex_vat": ("_revenue_ex", 2),
            "avg_weekly_revenue": ("_revenue / week_count", 2),
            "avg_weekly_revenue_ex_vat": ("_revenue_ex / week_count", 2),
        },
    )


def by_product(sales: DataFrame) -> DataFrame:
    """Units, revenue and mean margin per product, best seller first."""
    return exact_agg(
        sales,
        ["product_name"],
        {},
        {
            "units_sold": total("units_sold"),
            "revenue": total("revenue"),
            "margin_pct": mean("net_margin_pct", 1),
        },
    ).orderBy(F.col("units_sold").desc(), F.col("product_name"))


def discount_split(sales: DataFrame) -> DataFrame:
    return sales.groupBy("discount_applied").agg(F.count(F.lit(1)).alias("rows"))


def leaders(sales: DataFrame) -> DataFrame:
    """Top seller by units (above zero) and most profitable product; ties by name."""
    per_product = exact_agg(
        sales,
        ["product_name"],
        {},
        {
            "units": total("units_sold", None),
            "revenue": total("revenue", None),
            "profit": total("net_margin_eur * units_sold", None),
        },
    )

    def leading(measure: str, eligible: Column) -> Column:
        order = F.when(eligible, F.struct(-F.col(measure), F.col("product_name")))
        return F.min_by(F.struct("product_name", "units", "revenue", "profit"), order)

    picked = per_product.agg(
        leading("units", F.col("units") > 0).alias("s"), leading("profit", F.lit(True)).alias("p")
    )
    return select_rounded(
        picked,
        [
            "coalesce(s.product_name, '-') as top_seller",
            "coalesce(p.product_name, '-') as most_profitable",
        ],
        {
            "top_seller_units": ("coalesce(s.units, 0D)", 2),
            "top_seller_revenue": ("coalesce(s.revenue, 0D)", 2),
            "most_profitable_profit": ("p.profit", 2),
            "most_profitable_units": ("coalesce(p.units, 0D)", 2),
        },
    )


def filter_domains(sales: DataFrame) -> DataFrame:
    """Choices the filters offer: weeks, products and the date range, as rows.

    The sales are read once and shrink to weeks x products before they are
    taken apart.
    """
    seen = sales.groupBy("week_number", "product_name").agg(
        F.min("order_date").alias("lo"), F.max("order_date").alias("hi")
    )
    values = seen.selectExpr(
        "stack(3, 'week', string(week_number), 'product', product_name, 'date', '') as (kind, value)", "lo", "hi"
    )
    domains = values.groupBy("kind", "value").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return domains.selectExpr(
        """inline(if(kind = 'date',
            array(struct('min_date' as kind, string(lo) as value), struct('max_date' as kind, string(hi) as value)),
            array(struct(kind as kind, value as value))))"""
    ).filter("value <> ''")
