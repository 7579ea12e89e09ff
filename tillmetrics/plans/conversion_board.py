"""Conversion dashboard: selections, KPIs, axes and the weekly trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.fixed import UNKNOWN_CONVERSION_PRODUCT
from tillmetrics.functions.num import parsed, rounded
from tillmetrics.operators.keyed import first_per_key

TREND_PRODUCTS = 5


def normalize_rows(rows: DataFrame) -> DataFrame:
    """Typed conversion rows from all-text columns; blanks become 0 or a default name."""

    def number(name: str) -> Column:
        return F.coalesce(parsed(F.col(name)), F.lit(0.0))

    blank = F.lit("")
    return rows.select(
        "offer_id",
        F.coalesce(F.nullif(F.col("product_name"), blank), F.lit(UNKNOWN_CONVERSION_PRODUCT)).alias("product_name"),
        F.coalesce(F.col("ean"), blank).alias("ean"),
        F.col("date").try_cast("date").alias("date"),
        "period_type",
        "period_label",
        *[number(c).cast("bigint").alias(c) for c in ("visits_nl", "visits_be", "visits_total", "orders")],
        number("conversion_rate").alias("conversion_rate"),
    )


def newest_metrics(rows: DataFrame, seq: str) -> DataFrame:
    """Newest row per offer and period; of one date the later row."""
    return first_per_key(
        rows, ["offer_id", "period_type", "period_label"], F.col("date").desc_nulls_last(), F.col(seq).desc()
    )


def periods(metrics: DataFrame, period_type: str) -> DataFrame:
    """Period labels of one type, newest first by end date."""
    return (
        metrics.filter(F.col("period_type") == period_type)
        .groupBy("period_label")
        .agg(F.max("date").alias("end_date"))
        .orderBy(F.col("end_date").desc_nulls_last(), F.col("period_label").desc())
    )


def active_visits(country: str) -> Column:
    return F.col({"NL": "visits_nl", "BE": "visits_be"}.get(country, "visits_total"))


def _percent(orders: Column, visits: Column) -> Column:
    return F.when(
        visits > 0, orders.cast("double") / F.nullif(visits, F.lit(0)).cast("double") * 100.0
    ).otherwise(0.0)


def for_country(metrics: DataFrame, country: str) -> DataFrame:
    """Add the visits of the chosen country and recompute the conversion."""
    visits = active_visits(country)
    return metrics.withColumn("visits_active", visits).withColumn(
        "conversion_rate", _percent(F.col("orders"), visits)
    )


def search(rows: DataFrame, text: str) -> DataFrame:
    """Rows whose product name or offer id contains the text, whatever the case."""
    wanted = text.strip().lower()
    if not wanted:
        return rows
    return rows.filter(
        F.lower("product_name").contains(wanted) | F.lower("offer_id").contains(wanted)
    )


def selected_metrics(
    metrics: DataFrame, period_type: str, period_label: str | None = None, text: str = "", country: str = "ALL"
) -> DataFrame:
    rows = metrics.filter(F.col("period_type") == period_type)
    if period_label is not None:
        rows = rows.filter(F.col("period_label") == period_label)
    return for_country(search(rows, text), country)


def selected_daily(
    daily: DataFrame, chosen: DataFrame, period_type: str, period_label: str | None = None
) -> DataFrame:
    """Daily rows of the offers that are left in ``chosen``."""
    rows = daily.filter(F.col("period_type") == period_type)
    if period_label is not None:
        rows = rows.filter(F.col("period_label") == period_label)
    return rows.join(chosen.select("offer_id").distinct(), "offer_id", "left_semi")


def kpis(rows: DataFrame) -> DataFrame:
    """Orders, visits, overall conversion and the best row (ties by name, then offer)."""
    best = F.min_by(
        F.struct("product_name", "conversion_rate"),
        F.struct(-F.col("conversion_rate"), F.col("product_name"), F.col("offer_id")),
    )
    totals = rows.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("visits_active"), F.lit(0)).alias("total_visits"),
        best.alias("_best"),
    )
    return totals.select(
        "total_orders",
        "total_visits",
        rounded(_percent(F.col("total_orders"), F.col("total_visits")), 2).alias("avg_conversion"),
        F.coalesce(F.col("_best.product_name"), F.lit("-")).alias("top_product"),
        rounded(F.col("_best.conversion_rate"), 2).alias("top_conversion"),
    )


def daily_axis(daily: DataFrame, country: str = "ALL") -> DataFrame:
    """Visits and orders per day over all products, by date."""
    return (
        daily.withColumn("_visits", active_visits(country))
        .groupBy("date")
        .agg(F.sum("_visits").alias("visits"), F.sum("orders").alias("orders"))
        .orderBy("date")
    )


def trend(metrics: DataFrame, country: str = "ALL", top: int = TREND_PRODUCTS) -> DataFrame:
    """Weekly conversion of the products that lead in the latest week.

    Offers of one product add up before dividing. Every chosen product has
    a row for every week present, 0 where it had none; the list of weeks is
    bounded by the calendar and comes in as a scalar, not through a join.
    """
    weekly = (
        metrics.filter(F.col("period_type") == "WEEK")
        .withColumn("_visits", active_visits(country))
        .groupBy("product_name", F.col("date").alias("week_end"), "period_label")
        .agg(_percent(F.sum("orders"), F.sum("_visits")).alias("conversion"))
    )
    weeks = metrics.filter(F.col("period_type") == "WEEK").select(
        F.col("date").alias("week_end"), "period_label"
    )
    latest = weeks.agg(F.max("week_end")).scalar()
    all_weeks = weeks.agg(F.collect_set(F.struct("week_end", "period_label"))).scalar()
    leaders = (
        weekly.groupBy("product_name")
        .agg(F.coalesce(F.max(F.when(F.col("week_end") == latest, F.col("conversion"))), F.lit(0.0)).alias("latest_conversion"))
        .orderBy(F.col("latest_conversion").desc(), F.col("product_name"))
        .limit(top)
    )
    grid = leaders.select("product_name", "latest_conversion", F.inline(all_weeks))
    return (
        grid.join(weekly, ["product_name", "week_end", "period_label"], "left")
        .select(
            "product_name",
            "week_end",
            "period_label",
            rounded(F.coalesce("conversion", F.lit(0.0)), 4).alias("conversion"),
            rounded(F.col("latest_conversion"), 4).alias("latest_conversion"),
        )
    )
