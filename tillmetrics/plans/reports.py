"""Report tabs: chosen columns, labels and formatted values as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.fixed import PRODUCT_TAB, REVENUE_TAB
from tillmetrics.functions.dates import last_week


def formatted(value: Column, kind: str) -> Column:
    if kind == "date":
        return value.cast("date").cast("string")
    if kind == "number":
        return F.format_number(value, 0)
    if kind == "decimal":
        return F.format_number(value, 1)
    if kind == "percentage":
        return F.concat(F.format_number(value, 1), F.lit("%"))
    if kind == "currency_eur":
        return F.concat(F.lit("€ "), F.format_number(value, 2))
    return value.cast("string")


def tab(df: DataFrame, layout: Sequence[tuple[str, str, str]]) -> DataFrame:
    return df.select(*[formatted(F.col(c), kind).alias(label) for c, label, kind in layout if c in df.columns])


def in_last_week(df: DataFrame, day_column: str, today: str) -> DataFrame:
    """Rows from the Monday-to-Sunday week before ``today``."""
    start, end = last_week(F.lit(today).cast("date"))
    return df.filter(F.col(day_column).cast("date").between(start, end))


def revenue_tab(revenue: DataFrame) -> DataFrame:
    return tab(revenue, REVENUE_TAB)


def product_tab(performance: DataFrame) -> DataFrame:
    return tab(performance.withColumnRenamed("total_revenue", "revenue"), PRODUCT_TAB)
