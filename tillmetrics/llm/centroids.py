"""Centroid clustering in whole numbers, with bounds that planar geometry keeps tight.

The vectors are stored once, in buckets of a row number. A narrow state (cluster, upper
bound to the own centroid, lower bound to all others) is stored in the same buckets, so a
round joins it to the vectors without a shuffle. When the centroids move, the upper bound
grows by the own centroid's drift. The lower bound need not shrink by the full drift of
another centroid: all vectors of a cluster lie in a sphere, and in the plane through the
sphere's centre and the way the other centroid went, the approach is bounded by the angle
at which the sphere is seen. Only vectors whose bounds meet are read and scanned exactly;
only vectors that change their cluster enter the sums of a round.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .ship import ship

#: Rows a bucket holds at least and at most, on average.
BUCKET_ROWS = (10_000, 1_000_000)
#: Largest component after scaling: the squared distance of 64 such fits into a long.
LARGEST = 1 << 27
#: Relative slack of the floating-point bounds, far above their rounding errors.
SLACK = 1e-9


@dataclass
class Clusters:
    """assigned: (vec_id, cluster, distance). centroids: one row of whole numbers per cluster."""

    assigned: DataFrame
    centroids: list[list[int]]


def approach(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How much nearer centroid j can have come to any point of cluster i's sphere: (k, k).

    The sphere of cluster i has centre old[i] and radius[i]. For a point x let m be the
    middle of the way from old[j] to new[j], d its length and w the angle at m between x
    and the way. |x - old[j]| - |x - new[j]| is at most d cos w (a branch of a hyperbola
    lies between its asymptotes) and at most 0 where w is a right angle or more. The
    sphere is seen from m at an angle a from the way, and no point of it at less than
    a - asin(radius / |old[i] - m|).
    """
    way = new - old
    length = np.sqrt((way * way).sum(1))
    middle = (old + new) / 2
    to = old[:, None, :] - middle[None, :, :]
    far = np.sqrt((to * to).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.clip((to * way[None, :, :]).sum(2) / (far * length[None, :]), -1, 1)
        least = np.arccos(cosine) - np.arcsin(np.clip(radius[:, None] / far, 0, 1))
    nearer = length[None, :] * np.cos(np.clip(least, 0, np.pi / 2))
    outside = (far > radius[:, None]) & (length[None, :] > 0)
    return np.where(outside, nearer, length[None, :]) * (1 + SLACK)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, squared distance to the best other), exact; ties to the smaller number."""
    squares = np.empty((len(vectors), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        away = vectors - centroid
        squares[:, j] = (away * away).sum(1)
    cluster = squares.argmin(1)
    each = np.arange(len(vectors))
    own = squares[each, cluster]
    squares[each, cluster] = np.iinfo(np.int64).max
    return cluster, own, squares.min(1)


def whole_vectors(embeddings: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, comps array<long>): floor(scale * x) of vectors with `dims` components, all finite."""
    x = F.col(vector_col).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = embeddings.filter(x.isNotNull() & (F.size(x) == dims) & ~F.coalesce(odd, F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return kept.select(F.col(id_col).alias("vec_id"), whole.alias("comps"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _by_cluster(values: np.ndarray, index: Column) -> Column:
    """values[cluster] as a column; the list has one number per cluster."""
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), index + 1)


class _Buckets:
    """Tables in equal buckets of `pos` below one folder."""

    def __init__(self, scratch: str, spark, count: int):
        self.scratch, self.spark, self.count, self.made = scratch, spark, count, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        table = f"tillmetrics_{uuid.uuid4().hex}_{name}"
        writer = df.write.format("parquet").bucketBy(self.count, "pos").option("path", f"{self.scratch}/{name}")
        writer.saveAsTable(table)
        self.made.append(table)
        return self.spark.table(table)

    def forget(self) -> None:
        """Take the names out of the catalog; the files stay."""
        for table in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def _scan(state: DataFrame, base: DataFrame, centroids: list[list[int]], first: bool) -> DataFrame:
    """Rows of `state` with the cluster found among all centroids, new bounds, and the components of those that moved."""
    centres = np.array(centroids, np.int64)
    dims = centres.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cluster, own, other = nearest(_matrix(batch.column(2), dims), centres)
            old = batch.column(1).to_numpy(zero_copy_only=False)
            moved = pa.array(old != cluster)
            comps = pa.compute.if_else(moved, batch.column(2), pa.scalar(None, batch.column(2).type))
            columns = [
                batch.column(0),
                pa.array(cluster.astype(np.int32)),
                batch.column(1),
                pa.array(np.sqrt(own) * (1 + SLACK)),
                pa.array(np.where(other == np.iinfo(np.int64).max, np.inf, np.sqrt(other) * (1 - SLACK))),
                comps,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["pos", "cluster", "was", "upper", "lower", "comps"])

    kind = "pos long, cluster int, was int, upper double, lower double, comps array<long>"
    if first:
        rows = base.select("pos", F.lit(-1).alias("was"), "comps")
    else:
        rows = base.join(state.hint("shuffle_hash"), "pos").select("pos", F.col("cluster").alias("was"), "comps")
    return rows.mapInArrow(work, kind)


def _moves(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(change of the sums, change of the counts) of every cluster by the rows that moved."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            comps = _matrix(batch.column(2), dims)
            for column, sign in ((0, 1), (1, -1)):
                cluster = batch.column(column).to_numpy(zero_copy_only=False)
                inside = cluster >= 0
                np.add.at(sums, cluster[inside], sign * comps[inside])
                np.add.at(counts, cluster[inside], sign)
        table = np.column_stack([counts, sums])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k, dtype=np.int32), dims + 1)),
                pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), k)),
                pa.array(table.ravel()),
            ],
            names=["cluster", "place", "value"],
        )

    moved = state.filter(F.col("comps").isNotNull()).select("cluster", "was", "comps")
    partial = moved.mapInArrow(work, "cluster int, place int, value long")
    total = np.zeros((k, dims + 1), np.int64)
    for row in partial.groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect():
        total[row["cluster"], row["place"]] = row["value"]
    return total[:, 1:], total[:, 0]


def cluster(
    embeddings: DataFrame,
    *,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clusters:
    """Lloyd's rounds over floor(scale * x), exact in whole numbers, and one assignment more.

    Centroids start as the k vectors with the smallest sha256 of `seed:vec_id`; equal
    hashes go by the components, a null id comes last. A round assigns every vector to the
    nearest centroid (ties to the smaller number) and replaces every centroid that has
    vectors by floor(sum / count). With fewer than k vectors there are as many centroids.

    Null vectors and those with another length, a null or a non-finite component are left
    out; every other row gives one row, repeated rows and ids too. Components beyond
    2^27 after scaling end the query with an error, their distances would not fit into a
    long. Other columns are ignored; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    ship(spark)
    scratch = scratch_path(spark, "centroids")
    kept = whole_vectors(embeddings, id_col, vector_col, dims, scale)
    too_far = F.exists("comps", lambda v: F.abs(v) > LARGEST)
    kept = kept.withColumn("comps", F.when(too_far, F.raise_error(F.lit("a component is beyond 2^27"))).otherwise(F.col("comps")))
    # The number is stored with the row before anything depends on it.
    kept.withColumn("pos", F.monotonically_increasing_id()).write.parquet(f"{scratch}/rows")
    rows = spark.read.parquet(f"{scratch}/rows")
    n = rows.count()
    start_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = rows.orderBy(start_hash.asc_nulls_last(), "comps").limit(k).select("comps")
    centroids = [list(r[0]) for r in start.collect()]
    if not centroids:
        return Clusters(rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [])
    at_least, at_most = BUCKET_ROWS
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, -(-n // at_most), min(wanted, -(-n // at_least)))
    buckets = _Buckets(scratch, spark, count)
    try:
        return _rounds(buckets, rows.repartition(count, "pos"), centroids, rounds)
    finally:
        buckets.forget()


def _rounds(buckets: _Buckets, rows: DataFrame, centroids: list[list[int]], rounds: int) -> Clusters:
    k, dims = len(centroids), len(centroids[0])
    base = buckets.write(rows, "vectors")
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    state = buckets.write(_scan(base, base, centroids, True), "round0")
    for number in range(1, rounds + 1):
        change, joined = _moves(state, k, dims)
        sums, counts = sums + change, counts + joined
        new = [[s // int(c) for s in map(int, row)] if c else old for row, c, old in zip(sums, counts, centroids, strict=True)]
        if new == centroids:
            break
        radius = np.zeros(k)
        for row in state.groupBy("cluster").agg(F.max("upper").alias("r")).collect():
            radius[row["cluster"]] = row["r"]
        old_at, new_at = np.array(centroids, float), np.array(new, float)
        drift = np.sqrt(((new_at - old_at) ** 2).sum(1)) * (1 + SLACK)
        nearer = approach(old_at, new_at, radius)
        np.fill_diagonal(nearer, 0)
        index = F.col("cluster")
        loosened = state.select(
            "pos",
            "cluster",
            (F.col("upper") + _by_cluster(drift, index)).alias("upper"),
            (F.col("lower") - _by_cluster(nearer.max(1), index)).alias("lower"),
        )
        sure = F.col("upper") * (1 + SLACK) < F.col("lower") * (1 - SLACK)
        nothing = F.lit(None).cast("array<long>").alias("comps")
        settled = loosened.filter(sure).select("pos", "cluster", F.col("cluster").alias("was"), "upper", "lower", nothing)
        scanned = _scan(loosened.filter(~sure).select("pos", "cluster"), base, new, False)
        centroids = new
        state = buckets.write(settled.unionByName(scanned), f"round{number}")
    centres = F.array(*(F.array(*(F.lit(v).cast("long") for v in c)) for c in centroids))
    final = base.join(state.select("pos", "cluster").hint("shuffle_hash"), "pos")
    squares = F.zip_with("comps", F.element_at(centres, F.col("cluster") + 1), lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(squares, F.lit(0).cast("long"), lambda total, v: total + v)
    path = f"{buckets.scratch}/assigned"
    final.select("vec_id", "cluster", distance.alias("distance")).write.parquet(path)
    return Clusters(buckets.spark.read.parquet(path), centroids)


def report(found: Clusters) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector."""
    zero = [F.lit(0).cast("long"), F.lit("")]
    inertia = {r[0]: r[1] for r in found.assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    own = [F.lit(inertia.get(j, 0)).cast("long") for j in range(len(shas))] or zero[:1]
    index = F.col("cluster") + 1
    return found.assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(F.array(*own), index).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*(map(F.lit, shas) if shas else zero[1:])), index).alias("centroid_sha256"),
    )
