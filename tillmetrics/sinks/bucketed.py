"""Tables stored in buckets of a key: later joins and groups on the key need no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation

from tillmetrics.session import staged


def write_bucketed(
    df: DataFrame,
    name: str,
    key: str,
    buckets: int,
    path: str | None = None,
    measured: Mapping[str, Column] | None = None,
) -> dict:
    """Store ``df`` as table ``name`` in buckets of ``key``; returns ``measured`` over the rows written.

    Tables that are to be joined need equal ``buckets``. The rows are dealt by the key
    first, so that a task writes few buckets; adaptive execution splits a share that is
    large because of a hot key into several files of the bucket. A reader still takes a
    bucket in one task: use it for keys of bounded rows, such as order ids.

    ``measured`` are aggregates, taken in the tasks that write. They stand above the
    shuffle, in the tasks of the last stage, whose figures Spark counts once per part
    however often an executor is lost.
    """
    seen = Observation()
    # Stored rows let the shuffles they come from go before they are dealt out.
    with staged(df, "unplaced") as rows:
        placed = rows.hint("rebalance", buckets, key)
        if measured:
            placed = placed.observe(seen, *[value.alias(label) for label, value in measured.items()])
        writer = placed.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, key).sortBy(key)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    return dict(seen.get) if measured else {}
