"""CSV exports of summaries, weekly rollups and conversion tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillmetrics.fixed import (
    CONVERSION_COLUMNS,
    MARKETPLACE_WEEK_HEADERS,
    SUMMARY_HEADERS,
    WEBSHOP_WEEK_HEADERS,
)
from tillmetrics.functions.dates import range_label
from tillmetrics.plans.rollups import newest_first
from tillmetrics.session import freed_shuffles, staged


def _key(df: DataFrame) -> str:
    return "ean" if "ean" in df.columns else "sku"


def summary_report(summary: DataFrame) -> DataFrame:
    """Product summary under its report headers."""
    key = _key(summary)
    return summary.select(
        *[
            F.col(key).alias(key.upper()) if c == "product_key" else F.col(c).alias(label)
            for c, label in SUMMARY_HEADERS
        ]
    )


def weekly_report(rollup: DataFrame) -> DataFrame:
    """Weekly rollup as labelled rows; week_start stays as the split column.

    Marketplace rows show missing texts as '' and missing numbers as 0.
    """
    key = _key(rollup)
    shown = rollup.withColumn("week_text", F.concat(F.lit("Week "), F.col("iso_week"))).withColumn(
        "range_text", range_label(F.col("week_start"), F.col("week_end"))
    )
    headers = MARKETPLACE_WEEK_HEADERS if key == "ean" else WEBSHOP_WEEK_HEADERS
    if key == "ean":
        shown = shown.withColumn("latest_order", F.col("latest_order").cast("string")).na.fill(0).na.fill(
            "", ["product_name", key, "latest_order"]
        )
    columns = [F.col(key if c == "product_key" else c).alias(label) for c, label in headers]
    return shown.select("week_start", "week_end", "iso_week", *columns)


def conversion_export(rows: DataFrame) -> DataFrame:
    return rows.select(*CONVERSION_COLUMNS).withColumn("date", F.col("date").cast("string"))


def metrics_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(
        "period_type", "period_label", F.col("conversion_rate").desc_nulls_last(), "product_name", "offer_id"
    )


def daily_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("date").asc_nulls_last(), F.col("product_name").asc_nulls_last(), "offer_id")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that reads back as it was: line breaks and outer white space of names stay."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **kept).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    write_csv(summary_report(newest_first(summary)), path)


def week_folder(rollup: DataFrame) -> Column:
    """Name of the folder of a week, as the weekly reader expects it."""
    start, end = F.col("week_start").cast("string"), F.col("week_end").cast("string")
    week = F.lpad(F.col("iso_week").cast("string"), 2, "0")
    if _key(rollup) == "ean":
        return F.concat(F.lit("profitability_"), start, F.lit("_to_"), end, F.lit("_Week"), week, F.lit(".csv"))
    return F.concat(F.lit("shopify_week_"), week, F.lit("_"), start, F.lit("_to_"), end, F.lit(".csv"))


def write_weekly(rollup: DataFrame, path: str, compression: str | None = None) -> None:
    """One folder per week, ``file=<weekly file name>``, all weeks in one job.

    Rebalancing by week keeps a normal week in one file and splits a huge one. The rollup
    is stored before, so that its shuffles are gone when the weeks are dealt out.
    ``compression``: gzip for packed files, which the readers of this library take as well.
    """
    with staged(rollup, "rollup") as rows, freed_shuffles(rollup.sparkSession):
        report = weekly_report(rows).withColumn("file", week_folder(rows)).drop("week_start", "week_end", "iso_week")
        (
            report.hint("rebalance", "file")
            .write.mode("overwrite")
            .options(header=True, escape='"', compression=compression or "none")
            .partitionBy("file")
            .csv(path)
        )


def write_conversion(metrics: DataFrame, daily: DataFrame, path: str) -> None:
    write_csv(metrics_order(conversion_export(metrics)), f"{path}/bol_conversion_metrics.csv")
    write_csv(daily_order(conversion_export(daily)), f"{path}/bol_conversion_daily.csv")


def materialize(df: DataFrame, name: str, as_table: bool, path: str | None = None) -> None:
    """Staging models are views; marts are stored tables, below ``path`` where one is given."""
    if as_table:
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
