from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillmetrics import schemas
from tillmetrics.operators import keyed, scd
from tillmetrics.plans import loads
from tillmetrics.session import scratch_path
from tillmetrics.sinks.tables import KeyedTable, bucket_of

SCHEMA = "k string, n int, v double"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_last_row_per_key_wins(spark, rows):
    new = frame(spark, [("a", 1, 1.0), ("a", 3, 3.0), ("a", 2, 2.0), ("b", 1, None)])
    old = frame(spark, [("a", 0, 0.0), ("c", 0, 9.0)])
    out = keyed.replace_upsert(old, new, ["k"], ["n"])
    assert rows(out) == [("a", 3, 3.0), ("b", 1, None), ("c", 0, 9.0)]
    assert rows(keyed.replace_upsert(out, new, ["k"], ["n"])) == rows(out)


def test_group_limit_comes_before_the_shuffle(spark):
    plan = keyed.last_per_key(frame(spark, [("a", 1, 1.0)]), ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_upsert_of_some_columns(spark, rows):
    old = frame(spark, [("a", 1, 1.0), ("c", 1, 9.0)])
    new = frame(spark, [("a", 2, None), ("b", 2, 2.0)])
    out = keyed.replace_upsert(old, new, ["k"], ["n"], update_columns=["v"])
    assert rows(out) == [("a", 1, None), ("b", 2, 2.0), ("c", 1, 9.0)]


COSTS = "ean string, product_name string, original_price double, cogs double, estimated_ad_cost double"


def test_conditional_merge(spark, rows):
    old = frame(spark, [("1", "One", 10.0, 4.0, 1.0), ("2", None, None, None, None), ("9", "Nine", 1.0, 1.0, 1.0)], COSTS)
    new = frame(
        spark,
        [
            (1, "1", "", None, 5.0, None),
            (2, "1", "Uno", 0.0, None, None),
            (3, "1", None, None, None, 2.0),
            (1, "2", "", 3.0, None, None),
            (1, "3", "", None, None, None),
            (1, "4", None, 7.0, None, None),
            (2, "4", "Four", None, 1.0, None),
            (1, "5", None, None, None, None),
            (2, "5", "", None, None, None),
        ],
        f"seq int, {COSTS}",
    )
    want = [
        ("1", "Uno", 0.0, 5.0, 2.0),
        ("2", None, 3.0, None, None),  # a blank name does not replace a missing one
        ("3", "", None, None, None),  # the first row of a new key is taken as it is
        ("4", "Four", 7.0, 1.0, None),
        ("5", None, None, None, None),
        ("9", "Nine", 1.0, 1.0, 1.0),
    ]
    out = keyed.conditional_merge(old, new, "ean", ["seq"])
    assert rows(out) == want
    assert rows(keyed.conditional_merge(out, new, "ean", ["seq"])) == want


def test_merge_stamps_only_changed_rows(spark, rows):
    then, now = datetime(2026, 1, 1), datetime(2026, 2, 1)
    old = frame(spark, [("1", "a", None, None, None, then), ("2", "b", None, None, None, then)], schemas.MARKETPLACE_COSTS)
    new = frame(spark, [("1", "", None, 2.0, None)], COSTS)
    out = keyed.conditional_merge(old, new, "ean", ["cogs"], stamp_column="updated_at", stamp=F.lit(now).cast("timestamp_ntz"))
    assert rows(out, "ean", "updated_at") == [("1", now), ("2", then)]


def test_set_cost_keeps_the_other_columns(spark, rows):
    old = frame(spark, [("1", "One", 10.0, 4.0, 1.0)], COSTS)
    new = frame(spark, [("1", 5.0, None), ("2", 1.0, 2.0)], "ean string, cogs double, estimated_ad_cost double")
    assert rows(loads.set_costs(old, new, "ean")) == [("1", "One", 10.0, 5.0, 1.0), ("2", "", None, 1.0, 2.0)]


@pytest.mark.parametrize(
    "listed, left",
    [(["a"], ["", None, "b"]), ([""], ["a", "b"]), (["  "], ["a", "b"]), ([None], ["a", "b"]), (["a", ""], ["b"]), (["z"], ["", None, "a", "b"])],
)
def test_delete(spark, listed, left):
    table = frame(spark, [("a",), ("b",), ("",), (None,)], "k string")
    out = keyed.keyed_delete(table, frame(spark, [(x,) for x in listed], "k string"), "k")
    assert sorted((r.k for r in out.collect()), key=str) == sorted(left, key=str)


def test_stored_table(spark, rows):
    stored = KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"], buckets=4)
    assert rows(stored.read()) == []
    first = frame(spark, [(str(i), 1, float(i)) for i in range(50)])
    stored.upsert(first, ["n"])
    stored.upsert(first, ["n"])
    assert rows(stored.read()) == rows(first)
    stored.upsert(frame(spark, [("7", 2, -7.0), ("new", 2, 0.0)]), ["n"])
    got = {r.k: r.v for r in stored.read().collect()}
    assert (len(got), got["7"], got["new"], got["8"]) == (51, -7.0, 0.0, 8.0)


def test_stored_table_only_rewrites_touched_buckets(spark):
    stored = KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"], buckets=4)
    stored.upsert(frame(spark, [(str(i), 1, float(i)) for i in range(50)]), ["n"])

    def files_per_bucket():
        return {(r.key_bucket, r.version) for r in stored._state().collect()}

    before = files_per_bucket()
    change = frame(spark, [("7", 2, -7.0)])
    stored.upsert(change, ["n"])
    bucket = change.select(bucket_of(["k"], 4)).first()[0]
    after = files_per_bucket()
    assert {x for x in before if x[0] != bucket} == {x for x in after if x[0] != bucket}
    assert {x for x in before if x[0] == bucket}.isdisjoint(after)


def test_a_load_leaves_other_months_alone(spark, rows):
    schema = "id string, placed string, v int"
    stored = KeyedTable(spark, scratch_path(spark, "t"), schema, ["id"], buckets=2, within="left(placed, 7)")
    months = [(f"{m}-{i}", f"2026-{m:02d}-05T10:00:00Z", i) for m in (1, 2, 3) for i in range(6)] + [("x", None, 0)]
    stored.upsert(frame(spark, months, schema), ["v"])

    def files():
        return {(r.key_part, r.version) for r in stored._state().collect()}

    before = files()
    stored.upsert(frame(spark, [(f"3-{i}", "2026-03-05T10:00:00Z", 100 + i) for i in range(6)], schema), ["v"])
    after = files()
    assert {f for p, f in before if p != "p_2026-03"} == {f for p, f in after if p != "p_2026-03"}
    got = {r.id: r.v for r in stored.read().collect()}
    assert len(got) == 19 and got["3-5"] == 105 and got["2-5"] == 5
    plan = stored._stored().filter("key_part = 'p_2026-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_part" in plan


def test_interrupted_load_changes_nothing(spark, rows):
    stored = KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"], buckets=4)
    stored.upsert(frame(spark, [("a", 1, 1.0), ("b", 1, 1.0)]), ["n"])
    # rows of a load that died before its switch
    dead = frame(spark, [("a", 2, 2.0)]).select("*", *stored._place(4))
    dead.write.partitionBy("key_part", "key_bucket").parquet(f"{stored.path}/rows/version=v0000000002")
    assert rows(stored.read()) == [("a", 1, 1.0), ("b", 1, 1.0)]
    stored.delete(frame(spark, [("b",)], "k string"))
    assert rows(stored.read()) == [("a", 1, 1.0)]
    stored.upsert(frame(spark, [("a", 3, 3.0)]), ["n"])
    stored.vacuum()
    assert rows(stored.read()) == [("a", 3, 3.0)]


def test_table_grows_by_splitting_buckets(spark):
    stored = KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"], rows_per_bucket=500)
    stored.upsert(frame(spark, [("0", 1, 0.0)]), ["n"])
    assert [r.buckets for r in stored._state().collect()] == [1]
    many = spark.range(1800).selectExpr("cast(id as string) as k", "cast(2 as int) as n", "cast(id as double) as v")
    stored.upsert(many, ["n"])
    state = {r.key_bucket: r for r in stored._state().collect()}
    assert sorted(state) == [0, 1, 2, 3] and sum(r.rows for r in state.values()) == 1800
    stored.upsert(frame(spark, [("7", 3, -7.0)]), ["n"])
    after = {r.key_bucket: r for r in stored._state().collect()}
    assert sum(after[b].version != state[b].version for b in state) == 1
    # One bucket more: only the bucket that is split is rewritten, beside those of the new keys.
    more = spark.range(1800, 2300).selectExpr("cast(id as string) as k", "2 as n", "cast(id as double) as v")
    stored.upsert(more, ["n"])
    grown = stored._state().collect()
    assert {r.buckets for r in grown} == {5} and sum(r.rows for r in grown) == 2300
    got = {r.k: r.v for r in stored.read().collect()}
    assert len(got) == 2300 and got["7"] == -7.0 and got["2299"] == 2299.0


def test_growth_moves_keys_out_of_one_bucket_only(spark):
    ids = spark.range(3000)
    for n in range(1, 9):
        at = [bucket_of(["id"], m).alias(f"b{m}") for m in (n, n + 1)]
        moves = {tuple(r) for r in ids.select(*at).distinct().collect() if r[0] != r[1]}
        assert len(moves) == 1 and next(iter(moves))[1] == n


def test_a_key_that_changes_its_part_moves(spark, rows):
    schema = "id string, month string, v int"
    stored = KeyedTable(spark, scratch_path(spark, "t"), schema, ["id"], within="month", rows_per_bucket=10)
    stored.upsert(frame(spark, [(f"k{i}", "jan", i) for i in range(40)] + [(None, "jan", 0)], schema), ["v"])
    stored.upsert(frame(spark, [("k1", "feb", 100), (None, None, 1), ("new", "mar", 2)], schema), ["v"])
    got = rows(stored.read())
    assert len(got) == 42 and ("k1", "feb", 100) in got and (None, None, 1) in got
    # The places of a load that died before its switch are found again from the rows.
    stored._index(stored._current(), stored._state()).upsert(
        frame(spark, [("k2", "p_nowhere")], "id string, place string"), ["place"]
    )
    stored.upsert(frame(spark, [("k2", "feb", 200), ("k1", "jan", 300)], schema), ["v"])
    got = rows(stored.read())
    assert len(got) == 42 and ("k2", "feb", 200) in got and ("k1", "jan", 300) in got


def test_upsert_sends_one_row_per_key_and_task(spark):
    batch = frame(spark, [(None, i, 1.0) for i in range(9)])
    plan = keyed.replace_upsert(frame(spark, []), batch, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_null_keys_twice(spark, rows):
    batch = frame(spark, [(None, 1, 1.0), ("", 1, 2.0), ("a", 1, 3.0)])
    once = keyed.replace_upsert(frame(spark, []), batch, ["k"], ["n"])
    assert rows(keyed.replace_upsert(once, batch, ["k"], ["n"])) == rows(batch)
    assert rows(keyed.replace_upsert(once, batch, ["k"], ["n"], update_columns=["v"])) == rows(batch)
    stored = KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"])
    for _ in range(3):
        stored.upsert(batch, ["n"])
    assert rows(stored.read()) == rows(batch)


def test_blank_and_odd_coarse_partitions(spark, rows):
    schema = "id string, place string, v int"
    stored = KeyedTable(spark, scratch_path(spark, "t"), schema, ["id"], buckets=2, within="place")
    for i, place in enumerate(["", None, "none", "blank", "a/b=c %", "x y"]):
        stored.upsert(frame(spark, [(f"k{i}", place, i)], schema), ["v"])
        stored.upsert(frame(spark, [(f"l{i}", place, i)], schema), ["v"])
    assert len(rows(stored.read())) == 12


def test_stored_delete_may_empty_a_bucket(spark, rows):
    stored = KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"], buckets=64)
    stored.upsert(frame(spark, [("a", 1, 1.0), ("", 1, 1.0), (None, 1, 2.0), ("b", 1, 1.0)]), ["n"])
    stored.delete(frame(spark, [("a",)], "k string"))
    assert rows(stored.read(), "k") == [("",), ("b",), (None,)]
    stored.delete(frame(spark, [(" ",)], "k string"))
    assert rows(stored.read(), "k") == [("b",)]


def test_price_history(spark, rows):
    def at(month):
        return F.lit(f"2026-{month:02d}-01").cast("timestamp_ntz")

    snap = "product_id int, price double"
    h = scd.start_history(frame(spark, [(1, 1.0), (2, 2.0), (3, None)], snap), at(1))
    h = scd.apply_snapshot(h, frame(spark, [(1, 1.5), (3, None), (4, 4.0)], snap), "product_id", ["price"], at(2))
    h = scd.apply_snapshot(h, frame(spark, [(1, 1.5), (2, 2.0), (3, 3.0)], snap), "product_id", ["price"], at(3))
    one, two, three = (datetime(2026, m, 1) for m in (1, 2, 3))
    assert rows(h) == sorted(
        [
            (1, 1.0, one, two), (1, 1.5, two, None), (2, 2.0, one, None),
            (3, None, one, three), (3, 3.0, three, None), (4, 4.0, two, None),
        ],
        key=repr,
    )


def test_first_incremental_load_takes_everything(spark):
    source = frame(spark, [("a", 1, 1.0), ("b", 2, 1.0)])
    assert loads.rows_after(source, source.filter("false"), "n").count() == 2
    assert loads.rows_after(source, source.filter("n = 1"), "n").count() == 1
    odd = frame(spark, [("a", None, 1.0), ("b", -(2**31), 1.0), ("c", 5, 1.0)])
    assert loads.rows_after(odd, odd.filter("false"), "n").count() == 3
    assert loads.rows_after(odd, odd.filter("n < 0"), "n").count() == 1


def test_incremental_load_reads_only_newer_files(spark):
    path = scratch_path(spark, "days")
    days = spark.range(4000).selectExpr("id", "date_add(date '2024-01-01', cast(id / 100 as int)) as day")
    days.repartitionByRange(20, "day").write.parquet(path)
    source = spark.read.parquet(path)
    newer = loads.rows_after(source, source.filter("day < date '2024-02-05'"), "day")
    assert newer.count() == 500
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(day), GreaterThan(day" in plan or "DataFilters: [isnotnull(day" in plan
