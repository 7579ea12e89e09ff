"""Sorted pages and top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PAGE_SIZE = 10


def sort_keys(df: DataFrame, by: str, descending: bool) -> list[Column]:
    """Numbers by value, flags false before true, text without case; ties by all columns."""
    kind = df.schema[by].dataType
    key = F.col(by)
    if isinstance(kind, T.StringType):
        key = F.lower(F.coalesce(key, F.lit("")))
    first = key.desc_nulls_last() if descending else key.asc_nulls_last()
    ties = [F.col(c).asc_nulls_last() for c in df.columns]
    return [first, *ties]


def sorted_by(df: DataFrame, by: str, descending: bool = False) -> DataFrame:
    return df.orderBy(*sort_keys(df, by, descending))


def page(
    df: DataFrame, by: str = "revenue", descending: bool = True, number: int = 1, size: int = PAGE_SIZE
) -> DataFrame:
    """One page of the table; Spark keeps only the rows up to that page per task."""
    return sorted_by(df, by, descending).offset((number - 1) * size).limit(size)


def latest_rows(df: DataFrame, limit: int = 100, date_column: str = "date", ties: list[str] | None = None) -> DataFrame:
    """The newest rows first; ties in a fixed order so that reruns agree."""
    rest = ties if ties is not None else [c for c in df.columns if c != date_column]
    return df.orderBy(
        F.col(date_column).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]
    ).limit(limit)
