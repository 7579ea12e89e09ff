"""What the steps leave on disk, and how many files and micro-batches they make."""

import glob
import os

import pytest

from tillmetrics.catalog import load_all
from tillmetrics.catalog.documents import land
from tillmetrics.catalog.mapping import _SCHEMAS
from tillmetrics.catalog.registry import QUERIES
from tillmetrics.plans import spans
from tillmetrics.session import freed_shuffles, shared_folder, staged
from tillmetrics.sinks.bucketed import write_bucketed
from tillmetrics.sinks.tables import KeyedTable

load_all()


def left(spark, name):
    return set(glob.glob(shared_folder(spark).removeprefix("file:") + f"/tillmetrics/*/{name}"))


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables; lineitem is in six files, with a line per order and one that comes twice."""
    folder = str(tmp_path_factory.mktemp("room"))
    lineitem = spark.range(240).selectExpr(
        "id as l_orderkey", "id % 40 as l_partkey", "id % 3 as l_suppkey", "cast(1 as int) as l_linenumber",
        "cast(id % 5 + 1 as double) as l_quantity", "cast(id + 10 as double) as l_extendedprice", "0.1D as l_discount",
        "0.05D as l_tax", "if(id % 4 = 0, 'R', 'N') as l_returnflag", "if(id % 2 = 0, 'O', 'F') as l_linestatus",
        "cast(date_add(date'1995-01-01', cast(id * 12 as int)) as timestamp_ntz) as l_shipdate",
    )
    lineitem = lineitem.union(lineitem.filter("l_orderkey = 7")).repartition(6)
    orders = spark.range(240).selectExpr(
        "id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "cast(id + 10 as double) as o_totalprice",
        "cast(date_add(date'1995-01-01', cast(id * 12 as int)) as timestamp_ntz) as o_orderdate", "'1-URGENT' as o_orderpriority",
    )
    part = spark.range(600).selectExpr(
        "id as p_partkey", "concat('n', id) as p_name", "'b' as p_brand", "if(id % 3 = 0, 'LARGE', 'TINY') as p_type",
        "cast(id % 50 as int) as p_size", "cast(id + 1 as double) as p_retailprice",
    )
    for name, df in {"lineitem": lineitem, "orders": orders, "part": part}.items():
        assert [f.name for f in df.schema] == [c.split()[0] for c in _SCHEMAS[name].split(", ")]
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_product_files_hold_many_products(spark, sf):
    got = QUERIES["s5_product_files"](spark, sf)
    assert got.count() == 1200
    assert len(got.inputFiles()) == 6


def test_landed_documents_are_packed(spark, rows):
    df = spark.range(50).selectExpr("id", "concat('Straße\n', id) as t")
    path = land(df, spark, "docs")
    assert all(f.endswith(".json.gz") for f in spark.read.json(path).inputFiles())
    assert rows(spark.read.schema("id long, t string").json(path)) == rows(df)


@pytest.mark.parametrize("name", ["s10_weekly_files", "u1_weekly_files_to_sales", "s10_webshop_weekly_files"])
def test_weekly_files_are_packed(spark, sf, name):
    got = QUERIES[name](spark, sf)
    files = got.inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)
    # Dates twelve days apart: every line has a week of its own.
    assert got.count() == 240
    assert not left(spark, "rollup")


def test_upserts_leave_no_batch(spark, rows, tmp_path):
    before = left(spark, "batch")
    table = KeyedTable(spark, str(tmp_path / "t"), "k long, v long", ["k"], buckets=2)
    for shift in (0, 5):
        table.upsert(spark.range(8).selectExpr("id as k", f"id + {shift} as v"), ["v"])
    assert rows(table.read()) == [(k, k + 5) for k in range(8)]
    assert left(spark, "batch") == before


def test_ingested_documents_and_old_versions_go(spark, sf):
    before, tables = left(spark, "orders/*.json*"), left(spark, "items/rows/version=*")
    got = QUERIES["st1_auto_ingest"](spark, sf)
    assert got.count() == 480
    assert left(spark, "orders/*.json*") == before
    assert len(left(spark, "items/rows/version=*") - tables) == 1


def test_bucketed_table_from_stored_rows(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 10 as k", "id")
    write_bucketed(df, "room_bucketed", "k", 2, str(tmp_path / "b"))
    stored = spark.table("room_bucketed")
    assert stored.count() == 100
    assert all(".zstd" in f for f in stored.inputFiles())
    assert not left(spark, "unplaced")


def test_cells_in_two_steps(spark, rows, tmp_path):
    lines = spark.createDataFrame(
        [("p", "bol", o, d, 1, 2.5) for o in ("1", "2", None) for d in ("2024-01-01", "2024-01-01", "2024-01-05", None)],
        "product_id string, channel string, order_id string, day string, units int, revenue double",
    ).withColumn("day", spans.F.col("day").cast("date"))
    with staged(spans.daily_sums(lines), "days") as days:
        cells = spans.cells_of(days)
        spans.write_cells(cells, str(tmp_path / "cells"))
    assert rows(spark.read.parquet(str(tmp_path / "cells"))) == rows(spans.performance_cells(lines))
    assert not left(spark, "days") and not left(spark, "unsorted")


def test_a_batch_for_every_load(spark, sf):
    before = left(spark, "checkpoint/commits/[0-9]*")
    got = QUERIES["st3_first_seen_stream"](spark, sf)
    assert got.count() == 240
    # Four loads and the batches that only move the watermark; the files are six times as many.
    assert len(left(spark, "checkpoint/commits/[0-9]*") - before) <= 8


def test_setting_comes_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before
    assert os.path.isdir(shared_folder(spark).removeprefix("file:"))
