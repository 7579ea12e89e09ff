"""A table stored in ranges of its sort order, so that a page far down opens one range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillmetrics.operators.ranking import PAGE_SIZE, sort_keys

#: Rows a range should hold; Spark finds the bounds from samples, so ranges differ somewhat.
ROWS_PER_RANGE = 200_000


class StoredPages:
    """Ranges of a sort order in folders, and a directory with the rows of each.

    The order is that of ``ranking.sorted_by``: the column, then all columns. Rows that
    are equal in all columns are stored once with their number, so that no range grows
    with copies. Columns must be such that Spark can group by them, so no maps.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_range: int = ROWS_PER_RANGE):
        self.spark, self.path, self.rows_per_range = spark, path.rstrip("/"), rows_per_range
        self.order: tuple[str, bool] | None = None

    def write(self, df: DataFrame, by: str, descending: bool = False) -> None:
        self.order = by, descending
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        # Written once: finding the bounds of the ranges reads the rows before they are dealt.
        counted.write.mode("overwrite").parquet(f"{self.path}/rows")
        rows = self.spark.read.parquet(f"{self.path}/rows")
        ranges = max(1, -(-rows.count() // self.rows_per_range))
        dealt = rows.repartitionByRange(ranges, *sort_keys(df, by, descending))
        placed = dealt.withColumn("_range", F.spark_partition_id())
        placed.write.mode("overwrite").partitionBy("_range").parquet(f"{self.path}/ranges")
        per_range = self._ranges().groupBy("_range").agg(F.sum("_copies").alias("n"))
        # One row per range, so the running sum is small.
        before = F.sum("n").over(Window.orderBy("_range")) - F.col("n")
        directory = per_range.withColumn("before", before).coalesce(1)
        directory.write.mode("overwrite").parquet(f"{self.path}/directory")

    def _ranges(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/rows").schema.add("_range", "integer")
        return self.spark.read.schema(schema).parquet(f"{self.path}/ranges")

    def page(self, number: int, size: int = PAGE_SIZE) -> DataFrame:
        """Page ``number``, from 1; empty behind the last one. Only the ranges it lies in are read."""
        start, end = (number - 1) * size, number * size
        met = self.spark.read.parquet(f"{self.path}/directory").filter(F.col("before") < end)
        met = sorted((r["before"], r["_range"]) for r in met.filter(F.col("before") + F.col("n") > start).collect())
        rows = self._ranges().filter(F.col("_range").isin([r for _, r in met]))
        columns = [c for c in rows.columns if c not in ("_copies", "_range")]
        keys = sort_keys(rows.select(*columns), *self.order)
        # The rows of the page's ranges, a bounded number, are numbered in one task.
        last = F.sum("_copies").over(Window.orderBy(*keys)) + F.lit(met[0][0] if met else 0)
        placed = rows.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_copies"))
        shown = F.least("_last", F.lit(end)) - F.greatest("_first", F.lit(start))
        placed = placed.withColumn("_shown", shown).filter("_shown > 0")
        # As many copies as the page has room for.
        copies = placed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_shown"))))
        return copies.orderBy(*keys).select(*columns)
