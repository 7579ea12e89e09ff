"""Distinct orders, units and revenue per product over any span of days, from stored cells.

Distinct counts of days do not add up. What does add up: in a span, the lines of an order
on its first day there. That day's previous day with the same product and order lies before
the span or is absent. So cells (product, day, day before) with counts answer every span
exactly, and no order line is read again. Cells are as many as pairs of days a product's
orders return on, not as many as orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillmetrics.operators.exact import exact_results, exact_sums, sum_columns, total
from tillmetrics.operators.lookups import with_lookups
from tillmetrics.plans.unified import surrogate_key
from tillmetrics.session import freed_shuffles, staged

_PRODUCT = ["product_id", "channel"]
_MEASURES = {"total_revenue": total("revenue")}
_SUMS = sum_columns(_MEASURES)


def performance_cells(order_lines: DataFrame) -> DataFrame:
    """Cells of order lines: product_id, channel, order_id, day, units, revenue.

    Lines without a day lie in no span and are left out; lines without an order count
    for units and revenue only. Lines shrink to one row per product, order and day before
    the first shuffle, so a hot product or a missing order id is no hot group.
    """
    return cells_of(daily_sums(order_lines))


def daily_sums(order_lines: DataFrame) -> DataFrame:
    """One row per product, order and day."""
    dated = order_lines.filter("day is not null")
    return exact_sums(dated, [*_PRODUCT, "order_id", "day"], {"units": "sum(units)"}, _MEASURES)


def cells_of(per_day: DataFrame) -> DataFrame:
    """Cells of daily sums; the two steps apart let what is in between be stored."""
    before = F.lag("day").over(Window.partitionBy(*_PRODUCT, "order_id").orderBy("day"))
    cells = per_day.withColumn("day_before", before).groupBy(*_PRODUCT, "day", "day_before")
    return cells.agg(
        F.count("order_id").alias("n_orders"),
        F.sum("units").alias("units"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )


def write_cells(cells: DataFrame, path: str) -> None:
    """Cells sorted by day, so that a span opens the files of its days only.

    They are stored unsorted first, so that the shuffles they come from are gone when
    they are sorted.
    """
    with staged(cells, "unsorted") as rows, freed_shuffles(cells.sparkSession):
        placed = rows.repartitionByRange("day", "product_id").sortWithinPartitions("day", "product_id")
        placed.write.mode("overwrite").parquet(path)


def performance_between(
    cells: DataFrame, products: DataFrame, spans: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Performance per product in each span (label, first day, last day), both days included.

    All spans are answered in one pass over the cells between the earliest and the latest
    day asked for. Products without lines in a span have no row there.
    """
    asked = F.array(
        *[
            F.struct(F.lit(label).alias("span"), F.lit(a).cast("date").alias("first"), F.lit(b).cast("date").alias("last"))
            for label, a, b in spans
        ]
    )
    day = F.col("day")
    met = F.filter(asked, lambda s: (s["first"] <= day) & (day <= s["last"]))
    earliest, latest = min(a for _, a, _ in spans), max(b for _, _, b in spans)
    reached = cells.filter(day.between(F.lit(earliest).cast("date"), F.lit(latest).cast("date")))
    reached = reached.withColumn("s", F.explode(met)).withColumn("span", F.col("s.span"))
    is_first = F.col("day_before").isNull() | (F.col("day_before") < F.col("s.first"))
    per_product = reached.groupBy("span", *_PRODUCT).agg(
        F.sum(F.when(is_first, F.col("n_orders")).otherwise(0)).alias("total_orders"),
        F.sum("units").alias("units_sold"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )
    keyed = per_product.withColumn("product_key", surrogate_key(*_PRODUCT)).drop(*_PRODUCT)
    named = products.select("product_key", "product_name", "sku", "channel")
    shown = ["span", "product_name", "sku", "channel"]
    # A product has one row per span, so no key is hot.
    grouped = with_lookups(keyed, "product_key", named, how="inner", unique=True).groupBy(*shown).agg(
        *[F.sum(c).alias(c) for c in ["total_orders", "units_sold", *_SUMS]]
    )
    return exact_results(grouped, [*shown, "total_orders", "units_sold"], _MEASURES)
