"""As-of join: each row gets the history row of its key that was valid at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillmetrics.operators.lookups import hot_keys


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    time: str,
    valid_from: str,
    values: Sequence[str],
    slices: int | None = None,
) -> DataFrame:
    """``facts`` with ``values`` of the latest history row of their key up to ``time``, that moment included.

    Of several history rows of a key and moment the one with the largest values counts.
    Rows without a key or a time, and rows before their key's history, get NULL. No row
    is lost or repeated.

    Facts and history are united, sorted by time and the last value is carried down; no
    pairs are made. A key with more than one ``slices``-th of the rows is cut into slices
    of time, by quantiles of its own rows. What was valid at the start of a slice comes
    from one aggregate per slice, so neither the facts nor the history of one key meet in
    one task. ``slices``: else the number of shuffle partitions.
    """
    spark = facts.sparkSession
    slices = slices or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    usable = F.col(key).isNotNull() & F.col(time).isNotNull()
    changes = history.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    changes = changes.select(F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.struct(*values).alias("_value"))
    rows = facts.filter(usable).select(F.col(key).alias("_key"), F.col(time).alias("_at"), F.struct(*facts.columns).alias("_row"))
    both = rows.select("_key", "_at").union(changes.select("_key", "_at"))
    # Fewer hot keys than slices, and as many cuts per key: a small table by construction.
    share = [i / slices for i in range(1, slices)]
    hot = both.join(F.broadcast(hot_keys(both, "_key", slices)), "_key")
    moment = F.unix_micros(F.col("_at").cast("timestamp"))
    cuts = hot.groupBy("_key").agg(F.array_distinct(F.percentile_approx(moment, share, 10_000)).alias("_cuts"))

    def sliced(df: DataFrame) -> DataFrame:
        before = F.filter("_cuts", lambda c: c <= F.unix_micros(F.col("_at").cast("timestamp")))
        placed = df.join(F.broadcast(cuts), "_key", "left")
        return placed.withColumn("_slice", F.coalesce(F.size(before), F.lit(0))).drop("_cuts")

    changes = sliced(changes)
    # The last change of every slice of a hot key, carried to the slices after it.
    ends = changes.join(F.broadcast(cuts.select("_key")), "_key", "left_semi").groupBy("_key", "_slice")
    ends = ends.agg(F.max(F.struct("_at", "_value")).alias("_end"))
    grid = cuts.select("_key", F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_slice"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(ends, ["_key", "_slice"], "left").withColumn("_end", F.last("_end", True).over(earlier))
    carried = carried.filter(F.col("_end").isNotNull()).select(
        "_key", "_slice", F.col("_end._at").alias("_at"), F.col("_end._value").alias("_value")
    )
    known = changes.select("_key", "_slice", "_at", "_value").unionByName(carried)
    lines = sliced(rows).select("_key", "_slice", "_at", "_row")
    # A change comes before the rows of its moment; the larger of two changes comes last.
    window = Window.partitionBy("_key", "_slice").orderBy("_at", F.col("_value").isNull(), "_value")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mixed = lines.unionByName(known, allowMissingColumns=True).withColumn("_valid", F.last("_value", True).over(so_far))
    found = mixed.filter(F.col("_row").isNotNull()).select("_row.*", *[F.col(f"_valid.{v}").alias(v) for v in values])
    kinds = {f.name: f.dataType for f in history.schema}
    others = facts.filter(~usable).select(*facts.columns, *[F.lit(None).cast(kinds[v]).alias(v) for v in values])
    return found.unionByName(others)
