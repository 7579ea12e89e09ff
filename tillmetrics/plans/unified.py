"""Both channels together: orders, products, revenue and performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmetrics.fixed import MARKETPLACE, NULL_KEY_WORD, WEBSHOP
from tillmetrics.functions.dates import week_start
from tillmetrics.functions.num import rounded
from tillmetrics.operators.exact import exact_agg, mean, total
from tillmetrics.operators.lookups import with_lookups

def surrogate_key(*columns: str) -> Column:
    """md5 over the columns as text, NULL written as a fixed word."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_WORD)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def marketplace_order_totals(lines: DataFrame) -> DataFrame:
    """Order headers summed up from marketplace order lines."""
    return exact_agg(
        lines,
        ["order_id"],
        {"order_placed_at": "min(order_placed_at)"},
        {"total_price": total("total_price")},
    )


def unified_orders(marketplace: DataFrame, webshop: DataFrame) -> DataFrame:
    """UNION ALL of both channels' orders with a channel tag; absent columns are NULL."""
    left = marketplace.withColumn("channel", F.lit(MARKETPLACE))
    right = webshop.withColumn("channel", F.lit(WEBSHOP))
    return left.unionByName(right, allowMissingColumns=True)


def from_json_text(raw: DataFrame, text: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns read from a JSON text by path, cast to the wanted type.

    ``fields``: column name to (path, type).
    """
    others = [c for c in raw.columns if c != text]
    return raw.select(
        *others,
        *[
            F.get_json_object(F.col(text), path).try_cast(kind).alias(name)
            for name, (path, kind) in fields.items()
        ],
    )


def dim_products(marketplace: DataFrame, webshop: DataFrame) -> DataFrame:
    """Product list of both channels with a key over product and channel."""
    columns = ["product_id", "product_name", "sku", "category", "price"]
    both = (
        marketplace.select(*columns)
        .withColumn("channel", F.lit(MARKETPLACE))
        .unionByName(webshop.select(*columns).withColumn("channel", F.lit(WEBSHOP)))
    )
    return both.select(surrogate_key("product_id", "channel").alias("product_key"), *both.columns)


def fct_orders(unified: DataFrame) -> DataFrame:
    return unified.select(surrogate_key("order_id", "channel").alias("order_key"), *unified.columns)


def revenue_by_channel(orders: DataFrame) -> DataFrame:
    """Orders, revenue and average order value per day and channel."""
    return exact_agg(
        orders.withColumn("order_date", F.col("order_placed_at").cast("date")),
        ["order_date", "channel"],
        {"total_orders": "count(1)"},
        {"total_revenue": total("total_price"), "avg_order_value": mean("total_price")},
    )


def product_performance(order_lines: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders, units and revenue per product.

    ``order_lines``: product_key, order_id, units, revenue. Lines shrink to one
    row per product and order, then to one row per product, before the join.
    """
    per_order = exact_agg(
        order_lines, ["product_id", "channel", "order_id"], {"units": "sum(units)"}, {"revenue": total("revenue", None)}
    )
    per_product = exact_agg(
        per_order,
        ["product_id", "channel"],
        {"total_orders": "count(order_id)", "units_sold": "sum(units)"},
        {"revenue": total("revenue", None)},
    )
    # The text key is made for the few products only.
    per_product = per_product.withColumn("product_key", surrogate_key("product_id", "channel")).drop("product_id", "channel")
    named = products.select("product_key", "product_name", "sku", "channel")
    return exact_agg(
        with_lookups(per_product, "product_key", named, how="inner", unique=True),
        ["product_name", "sku", "channel"],
        {"total_orders": "sum(total_orders)", "units_sold": "sum(units_sold)"},
        {"total_revenue": total("revenue")},
    )


def convert_currency(
    df: DataFrame, amount: str, currency: str, rates: DataFrame, into: str, to: str = "EUR"
) -> DataFrame:
    """Add column ``into``: the amount in the target currency.

    ``rates``: currency, rate. Amounts already in the target currency and those
    without a rate stay as they are.
    """
    rate = rates.select(F.col("currency").alias(currency), F.col("rate").alias("_rate"))
    priced = with_lookups(df, currency, rate)
    converted = F.col(amount) * F.coalesce(F.col("_rate"), F.lit(1.0))
    return priced.select(
        *df.columns, F.when(F.col(currency) == to, F.col(amount)).otherwise(converted).alias(into)
    )


def channel_split(orders: DataFrame) -> DataFrame:
    """Revenue per channel and its share of the whole."""
    per_channel = exact_agg(
        orders, ["channel"], {"total_orders": "count(1)"}, {"revenue": total("total_price")}
    )
    whole = per_channel.agg(F.sum("revenue")).scalar()
    return per_channel.withColumn(
        "share_pct", rounded(F.col("revenue") / F.nullif(whole, F.lit(0.0)) * 100, 2)
    )


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    """Orders per weekday, 1 = Monday."""
    day = F.weekday(F.col("order_placed_at")) + 1
    return orders.groupBy(day.alias("weekday")).agg(F.count(F.lit(1)).alias("total_orders")).orderBy("weekday")


def weekly_growth(orders: DataFrame) -> DataFrame:
    """Weekly revenue per channel and its change against the week before.

    The window runs over rows already summed per week, a few per channel and
    year.
    """
    weekly = exact_agg(
        orders.withColumn("week_start", week_start(F.col("order_placed_at"))),
        ["channel", "week_start"],
        {},
        {"revenue": total("total_price")},
    )
    before = F.lag("revenue").over(Window.partitionBy("channel").orderBy("week_start"))
    return weekly.withColumn("previous_revenue", before).withColumn(
        "growth_pct",
        rounded(
            (F.col("revenue") - F.col("previous_revenue"))
            / F.nullif(F.col("previous_revenue"), F.lit(0.0))
            * 100,
            2,
        ),
    )


def best_and_worst(performance: DataFrame, n: int = 10) -> DataFrame:
    """The n products with the highest and the n with the lowest revenue."""
    ties = [F.col("channel"), F.col("sku"), F.col("product_name")]
    top = performance.orderBy(F.col("total_revenue").desc(), *ties).limit(n)
    bottom = performance.orderBy(F.col("total_revenue").asc(), *ties).limit(n)
    return top.withColumn("list", F.lit("top")).unionByName(bottom.withColumn("list", F.lit("bottom")))
