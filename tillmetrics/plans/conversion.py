"""Offer conversion: visits against units sold per offer and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.fixed import UNKNOWN_CATALOG_PRODUCT
from tillmetrics.functions.dates import period_array, written_between
from tillmetrics.functions.num import conversion_rate
from tillmetrics.operators.lookups import with_lookups


def offer_catalog(offers: DataFrame, costs: DataFrame) -> DataFrame:
    """Offer id, display name and EAN; the cost list's name comes first."""
    names = costs.select("ean", F.col("product_name").alias("_cost_name"))
    wanted = offers.filter(F.col("offer_id").isNotNull()).select("offer_id", "ean", "product_title")
    named = with_lookups(wanted, "ean", names, spread_by=["offer_id"])
    blank = F.lit("")
    return named.select(
        "offer_id",
        F.coalesce(
            F.nullif(F.col("_cost_name"), blank),
            F.nullif(F.col("product_title"), blank),
            F.lit(UNKNOWN_CATALOG_PRODUCT),
        ).alias("product_name"),
        F.coalesce(F.col("ean"), blank).alias("ean"),
    )


def _order_day(orders: DataFrame) -> Column:
    """Calendar day of the order as written, whatever its offset."""
    return F.col("order_placed_at").try_cast("timestamp_ntz").cast("date")


def _between(day: Column, start: str, end: str) -> Column:
    return day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def _in_range(orders: DataFrame, start: str, end: str, iso_text: bool) -> DataFrame:
    if iso_text:
        orders = orders.filter(written_between(F.col("order_placed_at"), start, end))
    return orders.filter(_between(_order_day(orders), start, end))


def units_by_offer(
    offers: DataFrame, orders: DataFrame, start: str, end: str, iso_text: bool = False
) -> DataFrame:
    """Units per offer in a date range, 0 for offers without orders.

    ``iso_text``: order moments are ISO texts, so that files of other days are skipped.

    Orders shrink to one row per EAN before they meet the offers. Offers that
    share an EAN are each credited with all of its units.
    """
    per_ean = _in_range(orders, start, end, iso_text).groupBy("ean").agg(F.sum("quantity").alias("_units"))
    wanted = offers.filter(F.col("offer_id").isNotNull()).select("offer_id", "ean")
    joined = with_lookups(wanted, "ean", per_ean, spread_by=["offer_id"])
    return joined.groupBy("offer_id").agg(F.coalesce(F.sum("_units"), F.lit(0)).alias("units_sold"))


def daily_units_by_offer(
    offers: DataFrame, orders: DataFrame, start: str, end: str, iso_text: bool = False
) -> DataFrame:
    """Units per offer and day; only days with orders. ``iso_text`` as in ``units_by_offer``."""
    day = _order_day(orders)
    per_ean_day = (
        _in_range(orders, start, end, iso_text)
        .groupBy("ean", day.alias("order_date"))
        .agg(F.sum("quantity").alias("_units"))
    )
    wanted = offers.filter(F.col("offer_id").isNotNull()).select("offer_id", "ean")
    # both sides hold at most one row per EAN and day, or per offer
    joined = with_lookups(wanted, "ean", per_ean_day, how="inner", spread_by=["offer_id"])
    return joined.groupBy("offer_id", "order_date").agg(
        F.coalesce(F.sum("_units"), F.lit(0)).alias("units_sold")
    )


def _periods(mode: str, reference_days: str | Sequence[str], legacy_label: bool = False) -> Column:
    """The wanted periods around one or several days, each once."""
    days = [reference_days] if isinstance(reference_days, str) else reference_days
    arrays = [period_array(mode, F.lit(d).cast("date"), legacy_label) for d in days]
    return arrays[0] if len(arrays) == 1 else F.array_distinct(F.concat(*arrays))


def with_periods(
    df: DataFrame, mode: str, reference_days: str | Sequence[str], legacy_label: bool = False
) -> DataFrame:
    """Each row once per period: a constant array is exploded, nothing is joined."""
    periods = _periods(mode, reference_days, legacy_label)
    return df.withColumn("_p", F.explode(periods)).select(*df.columns, "_p.*")


def in_periods(df: DataFrame, day: str, mode: str, reference_days: str | Sequence[str], legacy_label: bool = False) -> DataFrame:
    """Rows whose day lies in a wanted period, once per such period."""
    inside = lambda p: F.col(day).between(p["start_date"], p["end_date"])
    matching = F.filter(_periods(mode, reference_days, legacy_label), inside)
    return df.withColumn("_p", F.explode(matching)).select(*df.columns, "_p.*")


def _any_period(df: DataFrame, day: str, mode: str, reference_days: str | Sequence[str]) -> DataFrame:
    """Rows whose day lies in any wanted period, each once."""
    return df.filter(
        F.exists(_periods(mode, reference_days), lambda p: F.col(day).between(p["start_date"], p["end_date"]))
    )


def _units_per_period(
    offers: DataFrame, orders: DataFrame, mode: str, reference_days: str | Sequence[str], legacy_label: bool
) -> DataFrame:
    """Units per offer for every period from one scan of the orders."""
    dated = orders.select("ean", "quantity", _order_day(orders).alias("_day"))
    per_ean = (
        in_periods(dated, "_day", mode, reference_days, legacy_label)
        .groupBy("ean", "period_type", "period_label")
        .agg(F.sum("quantity").alias("_units"))
    )
    wanted = offers.filter(F.col("offer_id").isNotNull()).select("offer_id", "ean")
    joined = with_lookups(wanted, "ean", per_ean, how="inner", spread_by=["offer_id"])
    return joined.groupBy("offer_id", "period_type", "period_label").agg(F.sum("_units").alias("orders"))


def conversion_metrics(
    offers: DataFrame,
    costs: DataFrame,
    orders: DataFrame,
    visits: DataFrame,
    mode: str,
    reference_days: str | Sequence[str],
    legacy_label: bool = False,
) -> DataFrame:
    """One row per offer and period with visits, orders and conversion.

    ``visits``: offer_id, period_type and the three visit counts, one row per
    offer and period type; with a period_label as well when the periods of
    several days are wanted. Offers without visits or orders show 0.
    """
    catalog = with_periods(offer_catalog(offers, costs), mode, reference_days, legacy_label)
    units = _units_per_period(offers, orders, mode, reference_days, legacy_label)
    visit_keys = [c for c in ("offer_id", "period_type", "period_label") if c in visits.columns]
    counted = visits.select(*visit_keys, "visits_nl", "visits_be", "visits_total")
    joined = catalog.join(counted, visit_keys, "left").join(
        units, ["offer_id", "period_type", "period_label"], "left"
    )
    zero = F.lit(0)
    filled = joined.select(
        "offer_id",
        "product_name",
        "ean",
        F.col("end_date").alias("date"),
        "period_type",
        "period_label",
        *[
            F.coalesce(F.col(c), zero).cast("int").alias(c)
            for c in ("visits_nl", "visits_be", "visits_total", "orders")
        ],
    )
    return filled.withColumn("conversion_rate", conversion_rate(F.col("orders"), F.col("visits_total")))


def conversion_daily(
    offers: DataFrame,
    costs: DataFrame,
    orders: DataFrame,
    daily_visits: DataFrame,
    mode: str,
    reference_days: str | Sequence[str],
    legacy_label: bool = False,
) -> DataFrame:
    """One row per offer, day and period for days inside the period.

    ``daily_visits``: offer_id, day and the three visit counts, one row per
    offer and day.
    """
    catalog = offer_catalog(offers, costs)
    dated = orders.select("ean", "quantity", _order_day(orders).alias("day"))
    wanted_days = _any_period(dated, "day", mode, reference_days)
    per_ean_day = wanted_days.groupBy("ean", "day").agg(F.sum("quantity").alias("_units"))
    wanted = offers.filter(F.col("offer_id").isNotNull()).select("offer_id", "ean")
    units = (
        with_lookups(wanted, "ean", per_ean_day, how="inner", spread_by=["offer_id"])
        .groupBy("offer_id", "day")
        .agg(F.sum("_units").alias("orders"))
    )
    wanted_visits = _any_period(daily_visits, "day", mode, reference_days)
    points = wanted_visits.join(catalog, "offer_id").join(units, ["offer_id", "day"], "left")
    clipped = in_periods(points, "day", mode, reference_days, legacy_label)
    filled = clipped.select(
        "offer_id",
        "product_name",
        "ean",
        F.col("day").alias("date"),
        "period_type",
        "period_label",
        *[
            F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
            for c in ("visits_nl", "visits_be", "visits_total", "orders")
        ],
    )
    return filled.withColumn("conversion_rate", conversion_rate(F.col("orders"), F.col("visits_total")))
