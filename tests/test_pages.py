"""Pages out of stored ranges against a plain sort."""

import random

import pytest

from tillmetrics.operators.ranking import page
from tillmetrics.session import scratch_path
from tillmetrics.sinks.pages import StoredPages

SCHEMA = "name string, revenue double, flag boolean"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice([None, "", "a", "B", "b", "zz"]), rng.choice([None, 0.0, 1.5, 7.0, float(rng.randint(0, 90))]), rng.choice([None, True, False]))
        for _ in range(700)
    ]
    # A third of the rows are one row.
    return spark.createDataFrame(rows + [("hot", 7.0, True)] * 350, SCHEMA)


@pytest.mark.parametrize("by,descending", [("revenue", True), ("revenue", False), ("name", True), ("flag", False)])
def test_pages_equal_a_plain_sort(spark, table, by, descending):
    stored = StoredPages(spark, scratch_path(spark, "pages"), rows_per_range=40)
    stored.write(table, by, descending)
    whole = [tuple(r) for r in page(table, by, descending, 1, 2000).collect()]
    assert len(whole) == 1050
    for number, size in [(1, 10), (7, 33), (3, 300), (105, 10), (106, 10), (1, 2000)]:
        assert [tuple(r) for r in stored.page(number, size).collect()] == whole[(number - 1) * size : number * size]


def test_a_page_opens_its_ranges_only(spark, table):
    stored = StoredPages(spark, scratch_path(spark, "pages"), rows_per_range=20)
    stored.write(table, "revenue", True)
    assert stored._ranges().select("_range").distinct().count() > 5
    plan = stored.page(50)._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan.split("PartitionFilters")[1].split("]")[0] and "rangepartitioning" not in plan.split("Window")[-1]


def test_pages_of_an_empty_table(spark):
    stored = StoredPages(spark, scratch_path(spark, "pages"))
    stored.write(spark.createDataFrame([], SCHEMA), "revenue", True)
    assert stored.page(1).count() == 0
