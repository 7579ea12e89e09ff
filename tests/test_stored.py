"""Bucketed tables, checks taken while writing, and spans answered from cells."""

import random
from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from tillmetrics.operators import quality
from tillmetrics.plans import profitability, spans
from tillmetrics.session import scratch_path
from tillmetrics.sinks.bucketed import write_bucketed

LINES = "product_id string, channel string, order_id string, day date, units int, revenue double"


def stored(spark, df, key, buckets=4, measured=None):
    name = f"t_{uuid4().hex}"
    counts = write_bucketed(df, name, key, buckets, scratch_path(spark, name), measured)
    return spark.table(name), counts


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_join_of_bucketed_tables_has_no_shuffle(spark, rows):
    items = spark.range(400).selectExpr(
        "if(id % 7 = 0, null, string(id div 4)) as order_id", "string(id) as line_item_id", "string(id % 9) as sku",
        "'n' as name", "int(id % 5) + 1 as quantity", "id * 0.37D + 1 as price", "id * 0.01D as total_discount",
    )
    orders = spark.range(0, 100, 2).selectExpr(
        "string(id) as order_id", "timestamp_ntz '2025-01-05 00:00:00' as created_at", "if(id % 3 = 0, '/x', null) as landing_site"
    )
    costs = spark.range(6).selectExpr(
        "string(id) as sku", "concat('P', id) as product_name", "id * 2D as original_price", "1D as cogs", "0.1D as estimated_ad_cost"
    )
    plain = profitability.webshop_profitability(items, orders, costs)
    near = profitability.webshop_profitability(
        stored(spark, items, "order_id")[0], stored(spark, orders, "order_id")[0], costs, bucketed=True
    )
    assert rows(near) == rows(plain)
    plan = plan_of(near)
    assert "SortMergeJoin" in plan
    # The cost list is broadcast; nothing is dealt by hash.
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_checks_while_writing(spark, rows):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", None), ("c", 3), (None, 4), (None, 5), ("d", None)], "k string, v int"
    )
    table, counts = stored(spark, df, "k", 4, quality.null_counts(["k", "v"]))
    assert rows(table) == rows(df)
    assert rows(quality.not_null_from(spark, "t", counts)) == rows(quality.not_null(df, "t", ["k", "v"]))
    found = quality.unique(table, "t", ["k"])
    assert rows(found) == [("t", "unique", "k", 1)]
    assert "hashpartitioning" not in plan_of(found)
    assert "hashpartitioning" in plan_of(quality.unique(df, "t", ["k"]))


def test_checks_of_an_empty_table(spark, rows):
    table, counts = stored(spark, spark.createDataFrame([], "k string, v int"), "k", 4, quality.null_counts(["v"]))
    assert counts == {"v": 0} and table.count() == 0
    assert rows(quality.unique(table, "t", ["k"])) == [("t", "unique", "k", 0)]


def test_one_hot_key_keeps_all_rows(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', string(id)) as k", "id")
    table, counts = stored(spark, df, "k", 4, {"n": F.count(F.lit(1)), "s": F.sum("id")})
    assert counts == {"n": 3000, "s": sum(range(3000))}
    assert table.agg(F.sum("id"), F.count("id")).first() == (sum(range(3000)), 3000)


def test_spans_against_plain_counts(spark):
    rng = random.Random(4)
    first = date(2025, 12, 20)
    lines = [
        (
            rng.choice(["1", "1", "2", None]), rng.choice(["bol", "shopify"]),
            rng.choice([None, *[f"o{i}" for i in range(12)]]), rng.choice([None, *[first + timedelta(days=d) for d in range(20)]]),
            rng.choice([None, 1, 3]), rng.choice([None, 2.25, -1.5]),
        )
        for _ in range(500)
    ]
    lines += lines[:40]
    asked = [(f"{a}-{b}", str(first + timedelta(days=a)), str(first + timedelta(days=b))) for a in range(0, 20, 3) for b in range(a, 22, 2)]
    products = spark.createDataFrame([("1", "bol"), ("2", "bol"), ("1", "shopify"), ("9", "bol")], "p string, channel string")
    products = products.select(
        F.md5(F.concat_ws("-", "p", "channel")).alias("product_key"), F.concat(F.lit("P"), "p").alias("product_name"),
        F.col("p").alias("sku"), "channel",
    )
    path = scratch_path(spark, "cells")
    spans.write_cells(spans.performance_cells(spark.createDataFrame(lines, LINES)), path)
    got = {
        (x.span, x.sku, x.channel): (x.total_orders, x.units_sold, x.total_revenue)
        for x in spans.performance_between(spark.read.parquet(path), products, asked).collect()
    }
    want = {}
    for label, a, b in asked:
        for p, c in [("1", "bol"), ("2", "bol"), ("1", "shopify")]:
            met = [x for x in lines if x[0] == p and x[1] == c and x[3] and a <= str(x[3]) <= b]
            if met:
                units = [x[4] for x in met if x[4] is not None]
                money = [x[5] for x in met if x[5] is not None]
                want[label, p, c] = (
                    len({x[2] for x in met if x[2]}), sum(units) if units else None, sum(money) if money else None,
                )
    assert got == want


def test_spans_of_nothing(spark):
    cells = spans.performance_cells(spark.createDataFrame([], LINES))
    products = spark.createDataFrame([], "product_key string, product_name string, sku string, channel string")
    assert spans.performance_between(cells, products, [("x", "2025-01-01", "2025-01-31")]).count() == 0


def test_spans_prune_days_at_the_scan(spark):
    lines = spark.createDataFrame([("1", "bol", "o", date(2025, 1, 1), 1, 1.0)], LINES)
    path = scratch_path(spark, "cells")
    spans.write_cells(spans.performance_cells(lines), path)
    products = spark.sql("select md5('1-bol') as product_key, 'P' as product_name, '1' as sku, 'bol' as channel")
    plan = plan_of(spans.performance_between(spark.read.parquet(path), products, [("x", "2025-01-01", "2025-01-31")]))
    assert "GreaterThanOrEqual(day,2025-01-01)" in plan and "LessThanOrEqual(day,2025-01-31)" in plan
