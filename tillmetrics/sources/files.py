"""Cost lists, weekly report files, conversion exports and table counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics.fixed import MARKETPLACE_WEEK_FILE, RAW_TABLES, WEBSHOP_WEEK_FILE
from tillmetrics.functions.names import plain_header
from tillmetrics.functions.num import clean_number

_COST_NUMBERS = {"originalprice": "original_price", "cogs": "cogs", "estimatedadcost": "estimated_ad_cost"}


def tabs_to_commas(line):
    """A tab next to a comma belongs to it; any other tab is a separator itself."""
    line = F.replace(line, F.lit(",\t"), F.lit(","))
    line = F.replace(line, F.lit("\t,"), F.lit(","))
    return F.replace(line, F.lit("\t"), F.lit(","))


def cost_rows(rows: DataFrame, key: str, zero_is_missing: bool) -> DataFrame:
    """Typed cost rows from all-text columns, whatever the header style; no key, no row."""
    named = rows.toDF(*[plain_header(c) for c in rows.columns])

    def text(name: str):
        column = F.col(name) if name in named.columns else F.lit(None).cast("string")
        return F.trim(F.coalesce(column, F.lit("")))

    seq = ["seq"] if "seq" in named.columns else []
    return named.select(
        text(key).alias(key),
        text("productname").alias("product_name"),
        *[clean_number(text(h), zero_is_missing).alias(c) for h, c in _COST_NUMBERS.items()],
        *seq,
    ).filter(F.col(key) != "")


#: A field of a CSV line with the comma before it: quoted with doubled quotes, or plain.
_FIELD = r'(?:^|,)("[^"]*+(?:""[^"]*+)*+"(?=,|$)|[^,]*)'


def _cells(line):
    """The fields of a CSV line, however many."""
    fields = F.regexp_extract_all(line, F.lit(_FIELD), 1)
    quoted = lambda f: F.startswith(f, F.lit('"')) & F.endswith(f, F.lit('"')) & (F.length(f) > 1)
    bare = lambda f: F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
    return F.transform(fields, lambda f: F.when(quoted(f), bare(f)).otherwise(f))


def _cost_lists(spark: SparkSession, path: str, key: str, zero_is_missing: bool, tabs: bool) -> DataFrame:
    """Cost lists of any width, each read by its own header, which is its first line with text."""
    line = F.regexp_replace("value", "^\ufeff", "")
    lines = spark.read.text(path).select(
        (tabs_to_commas(line) if tabs else line).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    ).filter(F.trim("line") != "")
    parsed = lines.withColumn("cells", _cells(F.col("line")))
    titles = F.transform("cells", lambda c: F.regexp_replace(F.lower(F.trim(c)), "[ _]", ""))
    headers = parsed.groupBy("file").agg(
        F.min("at").alias("first"), F.min_by("line", "at").alias("header"), F.min_by(titles, "at").alias("titles")
    )
    rows = parsed.join(headers, "file").filter(F.col("line") != F.col("header"))
    wanted = [key, "productname", *_COST_NUMBERS, "seq"]
    found = [F.get("cells", F.array_position("titles", w).cast("int") - 1).alias(w) for w in wanted]
    return cost_rows(rows.select(*found), key, zero_is_missing).drop("seq")


def marketplace_costs(spark: SparkSession, path: str) -> DataFrame:
    """Marketplace cost lists, in which stray tabs stand for commas."""
    return _cost_lists(spark, path, "ean", zero_is_missing=True, tabs=True)


def webshop_costs(spark: SparkSession, path: str) -> DataFrame:
    return _cost_lists(spark, path, "sku", zero_is_missing=False, tabs=False)


def sales_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV with every column as text, so that keys keep their leading zeros.

    Quoted names may hold line breaks, as the exports of this library do; a file is
    then read by one task. Files known to have none are split with ``multi_line=False``.
    """
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)


def sales_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def weekly_files(
    spark: SparkSession, path: str | list[str], channel: str = "marketplace", multi_line: bool = True
) -> DataFrame:
    """All weekly files as one relation, columns by position, with the week of the name.

    Works for files and for folders of part files named alike; other names are
    left out. Product names may hold line breaks; files known to have none are split
    among tasks with ``multi_line=False``.
    """
    pattern, order = (
        (WEBSHOP_WEEK_FILE, (2, 3, 1)) if channel == "webshop" else (MARKETPLACE_WEEK_FILE, (1, 2, 3))
    )
    rows = sales_csv(spark, path, multi_line)
    where = F.col("_metadata.file_path")
    start, end, week = (F.regexp_extract(where, pattern, i) for i in order)
    return rows.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        start.alias("file_start"), end.alias("file_end"), week.try_cast("int").alias("file_week"),
    ).filter("file_start <> ''")


def conversion_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Conversion export: quoted fields, doubled quotes, all text, missing as ''.

    Product names may hold line breaks; exports known to have none are split among
    tasks with ``multi_line=False``.
    """
    return sales_csv(spark, path, multi_line).na.fill("")


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows per raw table; a table that does not exist counts 0."""
    if tables is None:
        tables = {t: spark.table(t) for t in RAW_TABLES if _exists(spark, t)}
    parts = []
    for name in RAW_TABLES:
        if name in tables:
            counted = tables[name].agg(F.count(F.lit(1)).alias("row_count"))
        else:
            counted = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        parts.append(counted.select(F.lit(name).alias("table_name"), "row_count"))
    return reduce(DataFrame.unionByName, parts)


def _exists(spark: SparkSession, table: str) -> bool:
    schema = table.rsplit(".", 1)[0]
    return spark.catalog.databaseExists(schema) and spark.catalog.tableExists(table)
