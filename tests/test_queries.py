"""Every registered query against its SQL on the smallest scale factor."""

import math
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillmetrics.catalog.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, Decimal):
            return float(v)
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canon(columns, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_catalog_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(oracle_sql()) <= set(queries())
