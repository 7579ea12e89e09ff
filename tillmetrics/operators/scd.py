"""Slowly changing dimension: history rows that open and close on change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def start_history(snapshot: DataFrame, at: Column) -> DataFrame:
    return snapshot.withColumn("valid_from", at).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))


def apply_snapshot(
    history: DataFrame, snapshot: DataFrame, key: str, check: Sequence[str], at: Column
) -> DataFrame:
    """Close open rows whose checked columns changed and open their successors.

    Keys absent from the snapshot stay open. One full outer join that reads the
    history once: closed rows have a join key of their own and pass through. Each
    key has one open row and one snapshot row; NULL keys never match.
    """
    data = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    is_open = F.col("valid_to").isNull()
    old = history.select(key, is_open.alias("_open"), F.struct(*history.columns).alias("_old"))
    new = snapshot.select(key, F.lit(True).alias("_open"), F.struct(*data).alias("_new"))
    pairs = old.join(new, [key, "_open"], "full_outer")
    same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check]
    unchanged = same[0]
    for test in same[1:]:
        unchanged = unchanged & test
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = had & has & ~unchanged
    never = F.lit(None).cast("timestamp_ntz")

    def row(source: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{source}.{c}").alias(c) for c in data],
            start.alias("valid_from"),
            end.alias("valid_to"),
        )

    end = F.when(F.col("_open"), F.when(changed, at).otherwise(never)).otherwise(F.col("_old.valid_to"))
    kept = F.when(had, row("_old", F.col("_old.valid_from"), end))
    opened = F.when(changed | (~had & has), row("_new", at, never))
    return pairs.select(F.explode(F.array_compact(F.array(kept, opened))).alias("r")).select("r.*")
