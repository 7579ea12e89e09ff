import json
from datetime import date

import pytest

from tillmetrics.operators import insights


def visits(spark, payload):
    text = payload if isinstance(payload, (str, type(None))) else json.dumps(payload)
    df = spark.createDataFrame([("o", text)], "offer_id string, payload string")
    return tuple(insights.country_visits(df).first())[2:]


def c(code, n, key="total", name="countryCode"):
    return {name: code, key: n}


@pytest.mark.parametrize(
    "payload, want",
    [
        ({"countries": [c("NL", 3), c("BE", 2), c("DE", 9)]}, (3, 2, 5)),
        ({"countries": [c("NL", 3)], "country": [c("NL", 4)]}, (7, 0, 7)),  # both lists count
        ({"countries": [c("nl", 3, "visits", "country")]}, (3, 0, 3)),
        ({"countries": [{"countryCode": "", "country": "be", "numberOfVisits": 2.9}]}, (0, 2, 2)),
        ({"offerInsights": [{"countries": [c("NL", 1)]}, {"items": [{"country": [c("BE", 5)]}]}]}, (1, 5, 6)),
        ({"total": 12}, (0, 0, 12)),
        ({"total": 99, "countries": [c("NL", 1)]}, (1, 0, 1)),
        ({"offerInsights": [{"total": 0}, {"count": 4}]}, (0, 0, 4)),
        ({"offerInsights": [{"total": 3}, {"count": 4}]}, (0, 0, 3)),
        ({"countries": [c("DE", 5)], "visits": 8}, (0, 0, 8)),
        ({"countries": [{"countryCode": "NL", "total": "7", "value": 2}]}, (2, 0, 2)),  # text is no count
        ({"countries": "none", "value": 6}, (0, 0, 6)),
        ({"countries": [None, c("NL", 1)]}, (1, 0, 1)),
        ({"offerInsights": ["x", {"countries": [c("NL", 4)]}]}, (4, 0, 4)),
        ({"insights": [3, {"countries": [c("BE", 4)]}], "total": 1}, (0, 4, 4)),
        ({"countries": [True, -1.5e3, "a, [b\"", c("NL", 2)], "name": "x, 1, y"}, (2, 0, 2)),
        ({"offerInsights": [["x"], c("NL", 9), {"countries": [[c("BE", 8)], c("NL", 4)]}]}, (4, 0, 4)),
        ({"countries": [[1], [[2]], {}, c("BE", 3), "s", None]}, (0, 3, 3)),
        ({"items": [[1, {"countries": [c("NL", 5)]}], {"countries": [c("NL", 1)]}]}, (1, 0, 1)),
        ({"countries": {"countryCode": "NL", "total": 3}, "count": 2}, (0, 0, 2)),
        ({"total": True, "value": 3}, (0, 0, 3)),  # a truth value is no count
        ({"total": "4", "value": None, "count": 3.9}, (0, 0, 3)),
        ('{"total": 1, "total": 5}', (0, 0, 5)),  # the last of a repeated field counts
        ({}, (0, 0, 0)),
        ([1], (0, 0, 0)),
        ("not json", (0, 0, 0)),
        (None, (0, 0, 0)),
    ],
)
def test_country_visits(spark, payload, want):
    assert visits(spark, payload) == want


def series(spark, payload):
    df = spark.createDataFrame([("o", json.dumps(payload))], "offer_id string, payload string")
    return {r.day: (r.visits_nl, r.visits_be, r.visits_total) for r in insights.daily_series(df).collect()}


def test_daily_series(spark):
    got = series(
        spark,
        {
            "insights": [{"day": "2026-01-01", "total": 5}],
            "periods": [
                {"date": "2026-01-02T23:00:00Z", "countries": [c("NL", 2), c("BE", 1)]},
                {"timestamp": "2026-01-03T00:30:00+01:00", "visits": 4},
                {"date": "someday", "total": 100},
                {"total": 100},
                {"date": "2026-01-01", "total": 6},  # the same day again: the last entry wins
            ],
            "offerInsights": [{"days": [{"day": "", "date": "2026-01-04", "country": [c("BE", 7)]}]}],
        },
    )
    assert got == {
        date(2026, 1, 1): (0, 0, 6),
        date(2026, 1, 2): (2, 1, 3),
        date(2026, 1, 3): (0, 0, 4),
        date(2026, 1, 4): (0, 7, 7),
    }


def test_daily_series_with_odd_elements(spark):
    days = [[7], {"date": "2024-01-16", "total": 5}, 3, "x", None, {"day": 20240117, "date": "2024-01-18", "total": 1}]
    assert series(spark, {"days": days}) == {date(2024, 1, 16): (0, 0, 5)}
    mixed = [1, {"day": 0, "date": None, "timestamp": "2024-01-19", "visits": 4}]
    assert series(spark, {"days": mixed}) == {date(2024, 1, 19): (0, 0, 4)}
    nested = {"offerInsights": [[1], {"days": [[{"date": "2024-01-20"}], {"date": "2024-01-21", "total": 2}]}, 4]}
    assert series(spark, nested) == {date(2024, 1, 21): (0, 0, 2)}
    assert series(spark, {"days": "x", "periods": {"date": "2024-01-21"}}) == {}


def test_daily_series_of_nothing(spark):
    assert series(spark, {"note": 1}) == {}


def test_total_is_the_sum_unless_it_falls_back(spark):
    payloads = [{"countries": [c("NL", n % 4), c("BE", n % 3)], "total": n} for n in range(40)]
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")
    for p, r in zip(payloads, insights.country_visits(df).collect()):
        both = r.visits_nl + r.visits_be
        assert r.visits_total == (both if both else p["total"])


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-15", date(2024, 1, 15)),
        ("20240115", date(2024, 1, 15)),
        ("20240115T10:00:00Z", date(2024, 1, 15)),
        ("2024-W03-1", date(2024, 1, 15)),
        ("2024W032", date(2024, 1, 16)),
        ("2024-W03", date(2024, 1, 15)),
        ("2024-W60-1", None),
        ("2024-1-5", date(2024, 1, 5)),
        ("20241501", None),
        ("2024011", None),
        ("someday", None),
    ],
)
def test_days_in_all_forms(spark, text, day):
    assert set(series(spark, {"days": [7, {"date": text, "total": 5}, "z"]})) == ({day} if day else set())
