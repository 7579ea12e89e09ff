"""Data tests: one small row per test with the number of failures."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmetrics.fixed import NOT_NULL, RELATIONSHIPS, UNIQUE

_RESULT = "table_name string, test string, column_name string, failures bigint"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass over the table."""
    counts = df.agg(*[value.alias(c) for c, value in null_counts(columns).items()])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    )
    return counts.select(F.explode(pairs).alias("r")).select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("test"),
        F.col("r.column_name"), F.col("r.failures"),
    )


def null_counts(columns: list[str]) -> dict[str, Column]:
    """The aggregates behind ``not_null``, to be taken while a table is written."""
    return {c: F.count_if(F.col(c).isNull()) for c in columns}


def not_null_from(spark: SparkSession, table: str, counts: Mapping[str, int]) -> DataFrame:
    """Rows of ``not_null`` from counts that are known: one per column."""
    return spark.createDataFrame([(table, "not_null", c, n) for c, n in counts.items()], _RESULT)


def unique(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """How many values of a key occur more than once; NULLs do not count.

    A table in buckets of the key is grouped where it lies, without a shuffle.
    """
    name = ", ".join(columns)
    keyed = df.select(*columns).dropna(how="any")
    repeated = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("test"),
        F.lit(name).alias("column_name"), "failures",
    )


def relationships(
    child: DataFrame, child_table: str, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose key has no parent.

    Both sides shrink to one row per key before they meet, so a key that fills
    the child table costs one row in the join.
    """
    keys = (
        child.filter(F.col(child_column).isNotNull())
        .groupBy(F.col(child_column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("_key")).distinct()
    return keys.join(known, "_key", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("failures")
    ).select(
        F.lit(child_table).alias("table_name"), F.lit("relationships").alias("test"),
        F.lit(child_column).alias("column_name"), "failures",
    )


def run_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared test of every given table."""
    parts = [not_null(tables[t], t, cols) for t, cols in NOT_NULL.items() if t in tables]
    parts += [unique(tables[t], t, [c]) for t, cols in UNIQUE.items() if t in tables for c in cols]
    parts += [
        relationships(tables[t], t, c, tables[p], pc)
        for t, c, p, pc in RELATIONSHIPS
        if t in tables and p in tables
    ]
    return _union(parts)
