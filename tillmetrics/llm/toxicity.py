"""Severity of toxic language by cumulative-link ordinal regression.

Features are the words of a text (letters and digits, ASCII lower case) and the
five-byte beginnings of longer words. One weight per feature is shared by all
thresholds: P(grade > k) = logistic(w.x - threshold[k]), thresholds ascending.
The severity of a text is its expected grade, the sum of these probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import TextBlock, lower_ascii, mix, text_blocks
from .rows import filter_by_text
from .ship import ship

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
PREFIX_BYTES = 5


def features(block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature) for every word and every beginning of a longer word."""
    block = TextBlock(lower_ascii(block.data), block.offsets)
    starts, ends = block.runs(_LETTER)
    rows = np.searchsorted(block.offsets, starts, "right") - 1
    words = block.span_hashes(starts, ends)
    long = ends - starts > PREFIX_BYTES + 1
    prefixes = mix(~block.span_hashes(starts[long], starts[long] + PREFIX_BYTES))
    return np.concatenate([rows, rows[long]]), np.concatenate([words, prefixes])


def counted(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs in order, with how often each occurs."""
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    return rows[first], keys[first], np.diff(np.append(first, len(rows)))


@dataclass
class Model:
    """Sorted feature keys, their weights, and the ascending thresholds."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, block: TextBlock) -> np.ndarray:
        """Rows x thresholds: P(grade > k)."""
        total = np.zeros(block.rows)
        if len(self.keys):
            rows, keys = features(block)
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            rows, at, times = counted(rows[known], at[known])
            np.add.at(total, rows, self.weights[at] * (1 + np.log(times)))
        return logistic(total[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def choose_features(rows: np.ndarray, keys: np.ndarray, bad: np.ndarray, most: int) -> np.ndarray:
    """The `most` features whose presence differs most between bad and other rows."""
    distinct, at = np.unique(keys, return_inverse=True)
    n_bad, n_other = max(1, int(bad.sum())), max(1, int((~bad).sum()))
    in_bad = np.bincount(at, weights=bad[rows], minlength=len(distinct))
    in_other = np.bincount(at, minlength=len(distinct)) - in_bad
    p, q = (in_bad + 0.5) / (n_bad + 1), (in_other + 0.5) / (n_other + 1)
    strength = (p - q) ** 2 / (p * (1 - p) / n_bad + q * (1 - q) / n_other)
    enough = np.flatnonzero(in_bad + in_other >= 3)
    best = enough[np.lexsort((distinct[enough], -strength[enough]))[:most]]
    return np.sort(distinct[best])


def derived_grades(
    rows: np.ndarray, at: np.ndarray, times: np.ndarray, n_features: int, bad: np.ndarray, grades: int
) -> np.ndarray:
    """0 for rows that are not bad; 1..grades for bad ones by how much telling language they hold.

    A feature is telling when bad rows hold it at least 20 times as often as the
    others. Bad rows are cut at the quantiles of their number of telling features.
    """
    n_bad, n_other = max(1, int(bad.sum())), max(1, int((~bad).sum()))
    in_bad = np.bincount(at, weights=bad[rows], minlength=n_features)
    in_other = np.bincount(at, minlength=n_features) - in_bad
    telling = (in_bad >= 3) & ((in_bad + 0.5) / n_bad >= 20 * (in_other + 0.5) / n_other)
    amount = np.bincount(rows, weights=np.where(telling[at], times, 0), minlength=len(bad))
    cuts = np.quantile(amount[bad], np.arange(1, grades) / grades) if bad.any() else np.zeros(grades - 1)
    return np.where(bad, 1 + (amount[:, None] > cuts[None, :]).sum(1), 0)


def fit_ordinal(
    rows: np.ndarray,
    at: np.ndarray,
    values: np.ndarray,
    n_features: int,
    grade: np.ndarray,
    weight: np.ndarray,
    grades: int,
    ridge: float,
    steps: int = 300,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by Adam on the weighted likelihood.

    The likelihood of grade g is P(> g-1) - P(> g); thresholds are a first value
    plus exponentials of free numbers, so they stay in order.
    """
    n = len(grade)
    w = np.zeros(n_features)
    steps_up = np.zeros(grades)
    share = [max(1e-4, float(weight[grade > k].sum() / weight.sum())) for k in range(grades)]
    steps_up[0] = np.log((1 - min(share[0], 0.9999)) / share[0])
    moments = [np.zeros(n_features + grades), np.zeros(n_features + grades)]
    total = weight.sum()
    for step in range(1, steps + 1):
        gaps = np.exp(np.clip(steps_up[1:], -6, 6))
        thresholds = np.concatenate([steps_up[:1], steps_up[0] + np.cumsum(gaps)])
        x = np.bincount(rows, weights=w[at] * values, minlength=n)
        above = np.ones((n, grades + 2))
        above[:, 1:-1] = logistic(x[:, None] - thresholds[None, :])
        above[:, -1] = 0
        each = np.arange(n)
        high, low = above[each, grade], above[each, grade + 1]
        p = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high), low * (1 - low)
        to_x = -weight * (slope_high - slope_low) / p / total
        to_threshold = np.zeros(grades)
        inner = grade > 0
        np.add.at(to_threshold, grade[inner] - 1, (weight * slope_high / p / total)[inner])
        inner = grade < grades
        np.add.at(to_threshold, grade[inner], (-weight * slope_low / p / total)[inner])
        slope_w = np.bincount(at, weights=to_x[rows] * values, minlength=n_features) + ridge * w
        tail = np.cumsum(to_threshold[::-1])[::-1]
        slope = np.concatenate([slope_w, tail[:1], tail[1:] * gaps])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope * slope
        move = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w -= move[:n_features]
        steps_up -= move[n_features:]
    gaps = np.exp(np.clip(steps_up[1:], -6, 6))
    return w, np.concatenate([steps_up[:1], steps_up[0] + np.cumsum(gaps)])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows_per_class: int = 4000,
    grades: int = 3,
    max_features: int = 8192,
    prior: float = 2.0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learn from at most `fit_rows_per_class` labelled rows of each class.

    The rows are those with the smallest hash of the id, whatever the number of
    partitions; `prior` is the precision of the weights' normal prior. Labels say
    toxic or not; the grades 1..`grades` of toxic rows are derived from how much
    telling language they hold (`derived_grades`). Without toxic rows nothing is
    toxic. Null labels and ids teach nothing; of rows that share an id the first
    text in order teaches, so the rows sent to the driver stay within the limits.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts.get(1):
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(grades, 60.0))
    sample = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows_per_class)
        sample = part if sample is None else sample.unionByName(part)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in text_blocks(batch.column(1)):
                rows, keys, times = counted(*features(block))
                cuts = pa.array(np.searchsorted(rows, np.arange(block.rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.ListArray.from_arrays(cuts, pa.array(keys.view(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    ],
                    names=["label", "keys", "times"],
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The sample is bounded by its two limits; an id that documents repeat teaches with one text.
    one = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    got = (
        one.select("label", "text")
        .mapInArrow(work, "label int, keys array<long>, times array<int>")
        .toArrow()
        .combine_chunks()
    )
    label = got.column("label").to_numpy()
    if not (label == 1).any():
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(grades, 60.0))
    lengths = got.column("keys").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(label), dtype=np.int32), lengths)
    keys = got.column("keys").combine_chunks().flatten().to_numpy().view(np.uint64)
    times = got.column("times").combine_chunks().flatten().to_numpy()
    bad = label == 1
    chosen = choose_features(rows, keys, bad, max_features)
    if len(chosen) == 0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(grades, 60.0))
    at = np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)
    kept = chosen[at] == keys
    rows, at, times = rows[kept], at[kept].astype(np.int32), times[kept]
    # Most features of the sample were not chosen; the driver needs them no more.
    del got, keys, kept, lengths
    pa.default_memory_pool().release_unused()
    grade = derived_grades(rows, at, times, len(chosen), bad, grades)
    got_of = {c: max(1, int((label == c).sum())) for c in (0, 1)}
    weight = np.where(bad, counts[1] / got_of[1], counts.get(0, 0) / got_of[0])
    values = 1 + np.log(times)
    weights, thresholds = fit_ordinal(rows, at, values, len(chosen), grade, weight, grades, prior / len(label))
    return Model(chosen, weights, thresholds)


def severity(
    docs: DataFrame, model: Model, threshold: float = 0.25, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, expected_severity, grade, toxic), one row per row of docs.

    expected_severity: the expected grade, 0 to the number of thresholds. grade:
    the most probable grade, the lower one on a tie. toxic: P(grade > 0) is at
    least `threshold`.

    Null and empty texts have no features and get the severity of the intercept
    alone. Repeated ids and rows give one row each; null ids stay null. Other
    columns are ignored. An empty table gives an empty result.
    """
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in text_blocks(batch.column(1)):
                above = model.above(block)
                edge = np.ones((block.rows, 1))
                shares = np.hstack([edge, above]) - np.hstack([above, 0 * edge])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(above.sum(1)),
                        pa.array(shares.argmax(1).astype(np.int32)),
                        pa.array(above[:, 0] >= threshold),
                    ],
                    names=["doc_id", "expected_severity", "grade", "toxic"],
                )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, expected_severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.25, *, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text is not toxic (as in `severity`)."""
    return filter_by_text(docs, text_col, lambda block: model.above(block)[:, 0] < threshold)
