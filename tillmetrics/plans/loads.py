"""Load strategies: full, append, incremental by high-water mark, cost changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillmetrics.operators.keyed import conditional_merge


def full_load(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def append_load(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


_LOWEST = {
    "date": "0001-01-01",
    "timestamp": "0001-01-01 00:00:00",
    "timestamp_ntz": "0001-01-01 00:00:00",
    "string": "",
    "byte": -(2**7),
    "short": -(2**15),
    "integer": -(2**31),
    "long": -(2**63),
    "float": "-inf",
    "double": "-inf",
}


def rows_after(source: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Source rows newer than everything loaded; all rows on the first load.

    The mark is compared plainly, so that Spark hands it to the files' statistics.
    Rows without a value, or with the type's lowest, come with the first load only.
    """
    kind = source.schema[column].dataType
    lowest = F.lit(_LOWEST[kind.typeName()]).cast(kind)
    mark = loaded.agg(F.coalesce(F.max(column), lowest)).scalar()
    first = loaded.agg(F.max(column).isNull()).scalar()
    newer = source.filter(F.col(column) > mark)
    lowest_ones = source.filter((F.col(column).isNull() | (F.col(column) <= lowest)) & first)
    return newer.unionByName(lowest_ones)


def set_costs(costs: DataFrame, changes: DataFrame, key: str, seq: Sequence[str] = ()) -> DataFrame:
    """Set cost columns of single keys; columns not given and NULLs stay as they are.

    ``seq``: columns that order several changes of a key, the last one wins per
    column. Without it a key may have one change only.
    """
    named = changes.withColumn("product_name", F.lit(""))
    return conditional_merge(costs, named, key, list(seq) or ["product_name"])


def cost_listing(costs: DataFrame, key: str) -> DataFrame:
    """Costs in listing order: marketplace by name, web shop by sku."""
    by = "product_name" if key == "ean" else key
    return costs.orderBy(F.col(by).asc_nulls_last(), F.col(key).asc_nulls_last())
