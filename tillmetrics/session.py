"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillmetrics")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillmetrics-"))
        return spark.sparkContext.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for one run's intermediate files."""
    return f"{shared_folder(spark)}/tillmetrics/{uuid.uuid4().hex}/{name}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in this block go when the write ends.

    Otherwise they stay until the driver happens to collect its garbage, and the
    shuffles of a job with several writes add up on disk.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def staged(df: DataFrame, name: str, spark: SparkSession | None = None) -> Iterator[DataFrame]:
    """``df`` written once and read back; its files go at the end of the block.

    For use by eager steps only: what reads the rows must run inside the block.
    ``spark``: the session to read with, where it is not the one of ``df``.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    try:
        with freed_shuffles(df.sparkSession):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.parquet(path)
    finally:
        remove_folder(spark, path)
