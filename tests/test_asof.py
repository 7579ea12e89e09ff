"""As-of join against a plain search."""

import random
from datetime import date, timedelta

import pytest

from tillmetrics.operators.asof import asof_join


def plain(facts, history):
    out = []
    for i, k, d in facts:
        valid = [(t, v, w) for hk, t, v, w in history if k is not None and d is not None and hk == k and t is not None and t <= d]
        last = max(valid, key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2]), default=(None, None, None))
        out.append((i, k, d, *last[1:]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slices", [2, 7])
def test_matches_a_plain_search(spark, rows, slices):
    rng = random.Random(slices)
    day = lambda: date(2026, 1, 1) + timedelta(days=rng.randint(0, 40))
    key = lambda: rng.choice([0, 0, 0, 1, 2, 3, 4, 5])
    facts = [(i, key(), day()) for i in range(300)] + [(900, None, day()), (901, 0, None), (902, 99, day()), (5, 0, day())]
    facts += facts[:3]
    history = [(key(), day(), rng.choice([None, 1.0, 2.0, 3.0]), str(i)) for i in range(120)]
    history += [(None, day(), 9.0, "x"), (1, None, 9.0, "x"), (7, day(), 9.0, "x"), history[0]]
    f = spark.createDataFrame(facts, "id int, k int, d date").repartition(3)
    h = spark.createDataFrame(history, "k int, since date, cost double, note string").repartition(3)
    assert rows(asof_join(f, h, "k", "d", "since", ["cost", "note"], slices)) == plain(facts, history)


def test_empty_sides(spark, rows):
    f = spark.createDataFrame([(1, 1, date(2026, 1, 1))], "id int, k int, d date")
    h = spark.createDataFrame([], "k int, since date, cost double")
    assert rows(asof_join(f, h, "k", "d", "since", ["cost"])) == [(1, 1, date(2026, 1, 1), None)]
    assert rows(asof_join(f.filter("false"), h, "k", "d", "since", ["cost"])) == []
