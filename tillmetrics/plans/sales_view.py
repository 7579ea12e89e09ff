"""One normalized sales view over files with differing column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tillmetrics.fixed import SALES_ALIASES, UNKNOWN_SALES_PRODUCT, VAT_DIVISOR, WEBSHOP_SALES_ALIASES
from tillmetrics.functions.flags import discount_flag
from tillmetrics.functions.names import pick
from tillmetrics.functions.num import select_rounded, text_number, whole_number
from tillmetrics.operators.lookups import with_lookups

READ_OUT = [
    "product_name", "ean", "units_sold", "revenue", "revenue_ex_vat", "net_selling_price",
    "selling_price", "original_price", "discount_used_pct", "cogs", "estimated_ad_cost",
    "net_margin_eur", "net_margin_pct", "order_date", "week_number", "discount_applied",
]


def column_for(df: DataFrame, target: str, channel: str = "marketplace") -> str | None:
    """The column of ``df`` that holds ``target``, or None."""
    aliases = SALES_ALIASES[target]
    if channel == "webshop":
        aliases = WEBSHOP_SALES_ALIASES.get(target, aliases)
    return pick(df.columns, aliases)


def _typed(df: DataFrame, channel: str) -> DataFrame:
    """The columns that were found, typed; NULL or a default for the others."""

    def found(target: str) -> Column | None:
        name = column_for(df, target, channel)
        return None if name is None else F.col(f"`{name}`")

    def number(target: str) -> Column:
        name = column_for(df, target, channel)
        if name is None:
            return F.lit(None).cast("double")
        column = F.col(f"`{name}`")
        currency_text = channel == "webshop" and isinstance(df.schema[name].dataType, StringType)
        return text_number(column) if currency_text else column.cast("double")

    def text(target: str) -> Column:
        column = found(target)
        return (F.lit(None) if column is None else column).cast("string")

    moment = found("order_date")
    flag = found("discount_applied")
    numbers = [
        "units_sold", "revenue", "net_margin_pct", "selling_price", "original_price", "cogs",
        "estimated_ad_cost", "net_margin_eur", "net_selling_price", "discount_used_pct",
    ]
    return df.select(
        text("product_name").alias("product_name"),
        text("ean").alias("ean"),
        text("week_number").alias("week_text"),
        *[number(n).alias(n) for n in numbers],
        (F.localtimestamp() if moment is None else moment.cast("timestamp_ntz")).alias("moment"),
        (F.lit(False) if flag is None else discount_flag(flag)).alias("discount_applied"),
    )


def normalized_sales(df: DataFrame, channel: str = "marketplace") -> DataFrame:
    """Sixteen typed columns from whatever columns the relation has.

    Names are resolved on the schema, so this is two projections of one scan:
    text to numbers first, then everything derived from them. Web-shop numbers
    may carry currency text, which is stripped.
    """
    typed = _typed(df, channel)
    # defaults of columns the relation does not have
    if column_for(df, "original_price", channel) is None and channel == "webshop":
        typed = typed.withColumn("original_price", F.col("selling_price"))
    if column_for(df, "net_selling_price", channel) is None:
        typed = typed.withColumn("net_selling_price", F.col("selling_price") / VAT_DIVISOR)
    week_digits = F.nullif(F.regexp_extract("week_text", r"(\d+)", 1), F.lit("")).try_cast("int")
    week = F.coalesce(whole_number(F.col("week_text")), week_digits, F.weekofyear("moment"))
    weeks = typed.withColumn("week_number", week)
    return select_rounded(
        weeks,
        [
            f"coalesce(product_name, '{UNKNOWN_SALES_PRODUCT}') as product_name",
            "coalesce(ean, '') as ean",
            "coalesce(units_sold, 0D) as units_sold",
            "coalesce(revenue, 0D) as revenue",
            "coalesce(net_selling_price, 0D) as net_selling_price",
            "coalesce(selling_price, 0D) as selling_price",
            "coalesce(nullif(original_price, 0D), selling_price, 0D) as original_price",
            "original_price > 0 and selling_price > 0 as _priced",
            "coalesce(discount_used_pct, 0D) as _given_pct",
            "coalesce(cogs, 0D) as cogs",
            "coalesce(estimated_ad_cost, 0D) as estimated_ad_cost",
            "coalesce(net_margin_eur, 0D) as net_margin_eur",
            "greatest(-100D, least(100D, coalesce(net_margin_pct, 0D))) as net_margin_pct",
            "date(moment) as order_date",
            "week_number",
            "discount_applied",
        ],
        {
            "revenue_ex_vat": ("coalesce(units_sold, 0D) * coalesce(net_selling_price, 0D)", 2),
            "_computed_pct": ("(original_price - selling_price) / nullif(original_price, 0D) * 100", 1),
        },
    ).selectExpr(
        *[c if c != "discount_used_pct" else "if(_priced, _computed_pct, _given_pct) as discount_used_pct" for c in READ_OUT]
    )


def read_out(sales: DataFrame) -> DataFrame:
    """Rows as the table shows them: dates as text, no NULLs."""
    return sales.select(*READ_OUT).withColumn(
        "order_date", F.coalesce(F.col("order_date").cast("string"), F.lit(""))
    ).na.fill(0).na.fill("")


def filtered(
    sales: DataFrame,
    week: int | None = None,
    start: str | None = None,
    end: str | None = None,
    products: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """Dashboard filter; a missing or empty choice keeps everything.

    ``products`` may be a list, or a DataFrame with product_name for sets of any
    size.
    """
    if week is not None:
        sales = sales.filter(F.col("week_number") == week)
    if start:
        sales = sales.filter(F.col("order_date") >= F.lit(start).cast("date"))
    if end:
        sales = sales.filter(F.col("order_date") <= F.lit(end).cast("date"))
    if isinstance(products, DataFrame):
        chosen = products.select("product_name").distinct()
        return with_lookups(sales, "product_name", chosen, how="left_semi").select(*sales.columns)
    names = list(products or [])
    return sales.filter(F.col("product_name").isin(names)) if names else sales
