"""Landed JSON documents of both channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmetrics import schemas
from tillmetrics.operators.flatten import offers, order_items
from tillmetrics.operators.keyed import first_per_key


def marketplace_order_documents(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Order documents landed below ``change_date=YYYY-MM-DD`` folders.

    The date range prunes folders. An order that shows up on several change
    dates is taken once, from the first.
    """
    schema = f"{schemas.ORDER_DOCUMENT}, change_date date"
    documents = spark.read.schema(schema).json(path)
    if start is not None:
        documents = documents.filter(F.col("change_date") >= F.lit(start).cast("date"))
    if end is not None:
        documents = documents.filter(F.col("change_date") <= F.lit(end).cast("date"))
    return first_seen(documents)


def first_seen(documents: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Each order id once, first change date wins; documents without id go.

    ``ties`` order documents of one change date; without them their text does.
    """
    named = documents.filter(F.coalesce(F.col("orderId"), F.lit("")) != "")
    rest = [F.col(c) for c in ties] or [F.to_json(F.struct("orderItems"))]
    return first_per_key(named, ["orderId"], F.col("change_date"), F.col("orderPlacedDateTime"), *rest)


def marketplace_orders(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    return order_items(marketplace_order_documents(spark, path, start, end)).drop("change_date", "item_pos")


def marketplace_offers(spark: SparkSession, path: str) -> DataFrame:
    return offers(spark.read.schema(schemas.OFFER_PAGE).json(path))


def webshop_orders(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Order objects from landed pages, created from start 00:00 UTC to end 23:59:59 UTC."""
    pages = spark.read.schema(schemas.WEBSHOP_ORDER_PAGE).json(path)
    rows = pages.select(F.explode("orders").alias("o")).select("o.*")
    return created_between(rows, start, end)


def created_between(orders: DataFrame, start: str | None, end: str | None) -> DataFrame:
    moment = F.col("created_at").try_cast("timestamp")
    if start is not None:
        orders = orders.filter(moment >= F.lit(f"{start}T00:00:00Z").cast("timestamp"))
    if end is not None:
        orders = orders.filter(moment <= F.lit(f"{end}T23:59:59Z").cast("timestamp"))
    return orders


def insights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INSIGHTS_DOCUMENT).json(path)


#: Tasks that read whole files at most; a session with many cores has more.
READ_TASKS = 1_000


def products(spark: SparkSession, path: str) -> DataFrame:
    """Products from files that hold one JSON document each.

    Spark counts every small file as several megabytes when it deals files to tasks, so
    the tasks are united.
    """
    tasks = max(READ_TASKS, 8 * spark.sparkContext.defaultParallelism)
    return products_from_text(spark.read.text(path, wholetext=True).coalesce(tasks), "value")


def products_from_text(df: DataFrame, column: str) -> DataFrame:
    """Products from ``{"products": [...]}`` texts or from bare lists of products."""
    listed = F.coalesce(
        F.from_json(F.col(column), schemas.PRODUCT_FILE)["products"],
        F.from_json(F.col(column), schemas.PRODUCT_LIST),
    )
    return df.select(F.explode(listed).alias("p")).select("p.*")
