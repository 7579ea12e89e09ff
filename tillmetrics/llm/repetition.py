"""Quality rules on repetition, found with a suffix array over the words of a text.

The suffixes of every text are ranked by prefix doubling over all texts of a
block at once. Neighbours in suffix order share a longest common prefix; the
larger one of its two neighbours is the longest repeat that starts at a word
(the LCP interval it belongs to). The spans of these maximal repeats are joined;
their share of the text and the longest one decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import TextBlock, text_blocks
from .rows import filter_by_text
from .ship import ship

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True

#: Limits of this method, below what the base rule allows already (20 % of the words in
#: repeats of 5 words or more, which holds all repeats of 8). Half of that in longer
#: repeats, which hardly come about by chance, is copied text.
MAX_COVERED = 0.1
MAX_LONGEST = 50
#: A passage found twice covers twice its words, so MAX_COVERED alone lets it take 5 %.
MAX_SHARE = 0.04

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def longest_repeats(items: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each item the length of the longest run from it that its row holds twice.

    items: 64-bit values of all rows back to back; bounds: rows + 1 positions.
    Occurrences may overlap.
    """
    n = len(items)
    if n == 0:
        return np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][row]
    order = np.lexsort((items, row))
    new = np.ones(n, bool)
    new[1:] = (items[order][1:] != items[order][:-1]) | (row[order][1:] != row[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels = [rank.copy()]
    same = ~new
    same[:-1] |= ~new[1:]
    active = order[same]
    width = 1
    while len(active):
        # Suffixes that agree on `width` items, by the next `width` items.
        follow = active + width
        inside = follow < end[active]
        second = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        by = np.lexsort((second, rank[active]))
        active, second = active[by], second[by]
        first = rank[active]
        group = np.ones(len(active), bool)
        group[1:] = first[1:] != first[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        at = np.arange(len(active))
        group_start = np.maximum.accumulate(np.where(group, at, 0))
        part_start = np.maximum.accumulate(np.where(part, at, 0))
        rank[active] = first + part_start - group_start
        shared = ~part
        shared[:-1] |= ~part[1:]
        active = active[shared]
        width *= 2
        levels.append(rank.copy())
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(n - 1, np.int64)
    for step in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = (a < end[left]) & (b < end[right])
        agree = inside & (levels[step][np.minimum(a, n - 1)] == levels[step][np.minimum(b, n - 1)])
        common += np.where(agree, 1 << step, 0)
    best = np.zeros(n, np.int64)
    best[right] = common
    best[left] = np.maximum(best[left], common)
    return best


def covered(longest: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Items per row inside the union of repeats of `least` items or more."""
    n = len(longest)
    change = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(longest >= least)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    total = np.zeros(n + 1, np.int64)
    np.cumsum(np.cumsum(change[:-1]) > 0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def row_max(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.int64)
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        out[filled] = np.maximum.reduceat(values, bounds[:-1][filled])
    return out


def duplicate_lines(block: TextBlock, spaces_total: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text, per row."""
    starts, ends, owner = block.lines()
    wordy = spaces_total[ends] > spaces_total[starts]
    starts, ends, owner = starts[wordy], ends[wordy], owner[wordy]
    hashes = block.span_hashes(starts, ends)
    order = np.lexsort((hashes, owner))
    equal = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][1:][equal], minlength=block.rows)


def measure(block: TextBlock, repeat_words: int) -> dict[str, np.ndarray]:
    """The base columns and the repeats of every row of a block."""
    starts, ends = block.words()
    bounds = block.row_bounds(starts)
    nonspace = np.zeros(len(block.data) + 1, np.int64)
    inside = np.zeros(len(block.data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    in_word = np.cumsum(inside[:-1]).astype(bool)
    np.cumsum(in_word, out=nonspace[1:])
    longest = longest_repeats(block.span_hashes(starts, ends), bounds)
    return {
        "n_words": np.diff(bounds),
        "word_chars": block.row_sums(in_word & ((block.data & 0xC0) != 0x80)),
        "n_symbols": block.row_sums(_SYMBOLS[block.data]),
        "n_dup_lines": duplicate_lines(block, nonspace),
        "n_repeat_words": covered(longest, bounds, 5),
        "covered_words": covered(longest, bounds, repeat_words),
        "longest_repeat": row_max(longest, bounds),
    }


def verdict(
    m: dict[str, np.ndarray], max_covered: float, max_longest: int, max_share: float, repeat_words: int
) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) for the measures of a block."""
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    longest = np.minimum(max_longest, np.maximum(repeat_words, max_share * m["n_words"]))
    varied = (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= longest)
    return failed, ~failed & varied


def rejections(
    rules: DataFrame,
    repeat_words: int = 8,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """One row from the rows of `repetition_rules`: how many each limit rejects.

    base: rows that fail the base rule. Of the others, covered: over the fraction;
    longest: over the longest repeat; covered_only, longest_only: over one alone.
    """
    covered = F.col("covered_words") > F.lit(max_covered) * F.col("n_words")
    scaled = F.greatest(F.lit(float(repeat_words)), F.lit(max_share) * F.col("n_words"))
    longest = F.col("longest_repeat") > F.least(F.lit(float(max_longest)), scaled)
    passed = ~F.col("base_failed")
    return rules.agg(
        F.count("*").alias("rows"),
        F.count_if("base_failed").alias("base"),
        F.count_if(passed & covered).alias("covered"),
        F.count_if(passed & longest).alias("longest"),
        F.count_if(passed & covered & ~longest).alias("covered_only"),
        F.count_if(passed & longest & ~covered).alias("longest_only"),
    )


def drop_repetitive(
    docs: DataFrame,
    repeat_words: int = 8,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    max_share: float = MAX_SHARE,
    *,
    text_col: str = "text",
) -> DataFrame:
    """The rows of docs, all columns, that `repetition_rules` keeps."""
    return filter_by_text(
        docs, text_col, lambda b: verdict(measure(b, repeat_words), max_covered, max_longest, max_share, repeat_words)[1]
    )


def repetition_rules(
    docs: DataFrame,
    repeat_words: int = 8,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    max_share: float = MAX_SHARE,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: word counts, repeats and the verdict `kept`.

    covered_words: words in the union of maximal repeats of `repeat_words` words
    or more. longest_repeat: words of the longest repeat. base_failed: fewer than
    10 words, or more than 20 % of the words in five-word windows found twice.
    kept: not base_failed, covered_words at most `max_covered` of the words and
    longest_repeat at most `max_longest` and at most `max_share` of the words (a
    repeat of up to `repeat_words` words passes in a text of any length).
    `rejections` counts what each limit rejects.

    Null and empty texts have no words, all counts 0, and fail the base rule.
    Repeated rows and ids give one row each. Other columns are ignored, so their
    names cannot clash. A long text is worked on as a block of its own; an empty
    table gives an empty result.
    """
    ship(docs.sparkSession)
    fields = pa.schema(
        [("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [("covered_words", pa.int64()), ("longest_repeat", pa.int64())]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in text_blocks(batch.column(1)):
                m = measure(block, repeat_words)
                failed, kept = verdict(m, max_covered, max_longest, max_share, repeat_words)
                columns = [batch.column(0).slice(lo, hi - lo), *m.values(), failed, kept]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=fields
                )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(work, SCHEMA)
