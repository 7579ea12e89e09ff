"""Equi-joins of a large table to lookup tables, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def plan_bytes(df: DataFrame) -> int | None:
    """Spark's own estimate of the size of ``df`` (metadata only, no job); None where it is not told."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(plan.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    number = text.rstrip("bkmg")
    return int(number) * _UNITS[text[len(number) :]]


def hot_keys(df: DataFrame, key: str, slices: int) -> DataFrame:
    """(``key``, _copies): the keys with more than one ``slices``-th of the rows.

    Their number is below ``slices``, whatever the data. Counts are exact and
    combine before the shuffle; nothing runs until the join does. _copies is the
    number of slices a key deserves.
    """
    counts = df.select(key).filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(key)).scalar()
    share = F.col("_n") * slices / total
    return counts.filter(share > 1).select(key, F.ceil(share).cast("int").alias("_copies"))


def with_lookups(
    facts: DataFrame,
    key: str,
    *lookups: DataFrame,
    how: str = "left",
    spread_by: list[str] | None = None,
    counts_from: DataFrame | None = None,
    unique: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Join ``facts`` to each lookup on ``key``.

    A lookup that Spark estimates below ``spark.sql.autoBroadcastJoinThreshold``
    is joined plainly and Spark broadcasts it; nothing is hinted, so the check of
    its size is Spark's. Beyond that, hot keys are cut into slices: fact rows
    of a hot key get a slice number from a hash of their own columns
    (``spread_by``, the same after a task is rerun), lookup rows of a hot key
    are repeated once per slice, and all big lookups share the one shuffle on
    (key, slice). Keys that are NULL match nothing and are spread the same way.
    Both paths give the same rows.

    ``counts_from``: a cheaper table whose keys are distributed like those of
    ``facts``, to find the hot keys in. ``unique``: ``facts`` has one row per key,
    so no key can be hot. ``slices``: into how many slices the rows are thought to be
    cut, and that all lookups count as big; else the number of shuffle partitions and
    Spark's estimate. A stream is joined without slices.
    """
    limit = broadcast_limit(facts) if slices is None else -1
    sizes = [plan_bytes(t) for t in lookups]
    small = [t for t, size in zip(lookups, sizes, strict=True) if size is not None and size <= limit]
    big = [t for t, size in zip(lookups, sizes, strict=True) if size is None or size > limit]
    if big and not facts.isStreaming and not unique:
        slices = slices or max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        # Fewer rows than slices: proven small enough to send to every task.
        hot = F.broadcast(hot_keys(facts if counts_from is None else counts_from, key, slices))
        columns = facts.columns
        row_hash = F.xxhash64(*(spread_by or columns))
        share = F.when(F.col(key).isNull(), F.lit(slices)).otherwise(F.coalesce("_copies", F.lit(1)))
        facts = facts.join(hot, key, "left").select(*columns, F.pmod(row_hash, share).cast("int").alias("_slice"))
        for table in big:
            names = table.columns
            sliced = table.filter(F.col(key).isNotNull()).join(hot, key, "left")
            copies = F.coalesce("_copies", F.lit(1))
            sliced = sliced.select(*names, F.explode(F.sequence(F.lit(0), copies - 1)).alias("_slice"))
            facts = facts.join(sliced, [key, "_slice"], how)
        facts, big = facts.drop("_slice"), []
    for table in small + big:
        facts = facts.join(table, key, how)
    return facts
