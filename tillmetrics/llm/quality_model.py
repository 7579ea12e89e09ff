"""Text quality by a regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics. The class means and
covariances come from sums that Spark adds up; covariances are shrunk towards
the pooled one and towards its diagonal. The score is the logistic function of
the difference of the two log densities, read off Mahalanobis distances with the
Cholesky factors kept in the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.session import scratch_path

from .arrays import TextBlock, lower_ascii, text_blocks
from .repetition import measure
from .ship import ship


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(b"0123456789")
_MARKS = _table(b".,;:?\"'()-")
_LOUD = _table(b"!")
_BRACKETS = _table(b"{}[]\\/@^_~=+`")
_HIGH = np.arange(256) >= 128

STATISTICS = (
    "log_words",
    "word_length",
    "symbols",
    "upper",
    "digits",
    "marks",
    "loud",
    "brackets",
    "high_bytes",
    "capital_words",
    "words_per_line",
    "duplicate_lines",
    "repeated_words",
    "longest_repeat",
    "distinct_words",
    "commonest_word",
    "same_neighbours",
    "no_words",
)
#: Shares are moved away from 0 by this before the logarithm.
SMALL_SHARE = 1e-3


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from; a null id is not held out (and has no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _distinct_and_commonest(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = len(bounds) - 1
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    if len(owner) == 0:
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(h)))
    most = np.zeros(rows)
    np.maximum.at(most, o[first], counts)
    return np.bincount(o[first], minlength=rows), most


def statistics(block: TextBlock) -> np.ndarray:
    """Rows x statistics, all finite; a text without words has shares of 0."""
    m = measure(block, 8)
    words = m["n_words"]
    starts, ends = block.words()
    bounds = block.row_bounds(starts)
    bytes_ = np.diff(block.offsets)
    some_words, some_bytes = np.maximum(words, 1), np.maximum(bytes_, 1)
    lower = TextBlock(lower_ascii(block.data), block.offsets)
    hashes = lower.span_hashes(starts, ends)
    distinct, commonest = _distinct_and_commonest(hashes, bounds)
    owner = np.repeat(np.arange(block.rows), np.diff(bounds))
    twin = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    capital = np.bincount(owner[_UPPER[block.data[starts]]], minlength=block.rows)
    line_starts, _, line_owner = block.lines()
    lines = np.bincount(line_owner, minlength=block.rows)

    def share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.log(count / of + SMALL_SHARE)

    def bytes_in(member: np.ndarray) -> np.ndarray:
        return share(block.row_sums(member[block.data]), some_bytes)

    return np.column_stack(
        [
            np.log1p(words),
            np.log1p(m["word_chars"] / some_words),
            share(m["n_symbols"], some_bytes),
            bytes_in(_UPPER),
            bytes_in(_DIGIT),
            bytes_in(_MARKS),
            bytes_in(_LOUD),
            bytes_in(_BRACKETS),
            bytes_in(_HIGH),
            share(capital, some_words),
            np.log1p(words / np.maximum(lines, 1)),
            share(m["n_dup_lines"], np.maximum(lines, 1)),
            share(m["n_repeat_words"], some_words),
            share(m["longest_repeat"], some_words),
            share(distinct, some_words),
            share(commonest, some_words),
            share(np.bincount(owner[1:][twin], minlength=block.rows), some_words),
            (words == 0).astype(float),
        ]
    )


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<double>), one row per row of docs; null text counts as empty."""
    ship(docs.sparkSession)
    fields = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in text_blocks(batch.column(1)):
                stats = statistics(block)
                flat = pa.array(stats.ravel())
                cuts = pa.array(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32))
                ids = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(cuts, flat)], schema=fields)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, stats array<double>")


@dataclass
class Model:
    """Means, inverse Cholesky factors and log determinants by class (0, 1)."""

    means: list[np.ndarray]
    whiten: list[np.ndarray]
    log_dets: list[float]
    log_prior: float
    constant: float | None = None

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        parts = []
        for mean, whiten, log_det in zip(self.means, self.whiten, self.log_dets, strict=True):
            z = (stats - mean) @ whiten.T
            parts.append(-0.5 * ((z * z).sum(1) + log_det))
        margin = np.clip(parts[1] - parts[0] + self.log_prior, -700, 700)
        return 1 / (1 + np.exp(-margin))


def model_from_sums(sums: dict[int, np.ndarray], d: int, shrink: float, ridge: float) -> Model:
    """sums: per class the count, the sums and the products of the statistics."""
    counts = {c: v[0] for c, v in sums.items()}
    if not counts.get(0) or not counts.get(1):
        known = 1.0 if counts.get(1) else 0.0 if counts.get(0) else 0.5
        return Model([], [], [], 0.0, known)
    means, scatter = [], []
    for c in (0, 1):
        mean = sums[c][1 : d + 1] / counts[c]
        means.append(mean)
        scatter.append(sums[c][d + 1 :].reshape(d, d) - counts[c] * np.outer(mean, mean))
    pooled = (scatter[0] + scatter[1]) / (counts[0] + counts[1])
    target = 0.5 * pooled + 0.5 * np.diag(np.diag(pooled))
    whiten, log_dets = [], []
    for c in (0, 1):
        weight = shrink + (1 - shrink) * d / (d + counts[c])
        cov = (1 - weight) * scatter[c] / counts[c] + weight * target + ridge * np.eye(d)
        factor = np.linalg.cholesky((cov + cov.T) / 2)
        whiten.append(np.linalg.inv(factor))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Model(means, whiten, log_dets, float(np.log(counts[1] / counts[0])))


def fit(labelled: DataFrame, shrink: float = 0.05, ridge: float = 1e-3) -> Model:
    """labelled: (label 0/1, stats). Rows with another label or null are left out.

    Every row counts; what reaches the driver is one number per class and cell.
    """
    ship(labelled.sparkSession)
    d = len(STATISTICS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            stats = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(label), d)
            for c in (0, 1):
                x = stats[label == c]
                sums[c, 0] += len(x)
                sums[c, 1 : d + 1] += x.sum(0)
                sums[c, d + 1 :] += (x.T @ x).ravel()
        classes, cells = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(classes.astype(np.int32)), pa.array(cells.astype(np.int32)), pa.array(sums[classes, cells])],
            names=["label", "cell", "value"],
        )

    rows = (
        labelled.filter(F.col("label").isin(0, 1))
        .select(F.col("label").cast("int").alias("label"), "stats")
        .mapInArrow(work, "label int, cell int, value double")
        .groupBy("label", "cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    sums = {c: np.zeros(1 + d + d * d) for c in (0, 1)}
    for row in rows:
        sums[row.label][row.cell] = row.value
    return model_from_sums(sums, d, shrink, ridge)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for (doc_id, stats)."""
    ship(stats.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"]
                )

    return stats.select("doc_id", "stats").mapInArrow(work, "doc_id long, score double")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    shrink: float = 0.05,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of docs.

    The model learns from every labelled row that is not held out (`held_out`);
    score is the probability of label 1, predicted is 1 from `threshold` on.

    Null and empty texts are scored like any other: all shares 0 and a statistic
    that says there are no words. Null labels and labels other than 0 and 1 teach
    nothing; with one class only, every score is that class, without any label it
    is 0.5. Rows with the same id are each scored and each learned from. Other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "document_statistics")
    document_statistics(docs, id_col, text_col).write.parquet(path)
    stats = spark.read.schema("doc_id long, stats array<double>").parquet(path)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    model = fit(stats.filter(~held_out(F.col("doc_id"))).join(known, "doc_id").select("label", "stats"), shrink)
    return score(stats, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
