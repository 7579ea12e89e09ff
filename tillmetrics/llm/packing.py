"""Documents packed into fixed windows by Karmarkar-Karp multiway differencing.

Every document becomes token ids and a closing id; whole windows are cut off it,
the rest is cut into parts. Parts are dealt into lots of bounded size. In a lot,
partial partitions into k windows are kept as sorted sums; the two with the
largest spread are merged with opposing order until one is left. If its fullest
window is over capacity, k rises by one and the lot is done again.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.session import scratch_path

from .ship import ship

#: Parts a lot holds on average; more make the windows more equal.
LOT_PARTS = 2000

#: Texts of these characters are split alike by both tokenizer libraries.
_COMMON = re.compile(r"[^\x00-\u024f\u2010-\u2026\u20ac]|<\|endoftext\|>")
_SPACES = re.compile(r"\s\s")
# The patterns of the vocabulary's pre-tokenizer, the second one for
# texts in which no two white space characters stand together.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_PATTERN_SINGLE = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""


def _byte_of_char() -> dict[str, int]:
    """The vocabulary's printable stand-ins for bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoders(path: str):
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    table = _byte_of_char()
    ranks = {bytes(table[c] for c in word): i for word, i in vocab.items() if all(c in table for c in word)}
    special = {word: i for word, i in vocab.items() if word.startswith("<|")}
    ranks = {word: i for word, i in ranks.items() if i not in special.values()}
    single, full = (
        tiktoken.Encoding(f"vocabulary{n}", pat_str=p, mergeable_ranks=ranks, special_tokens={})
        for n, p in enumerate((_PATTERN_SINGLE, _PATTERN))
    )
    return single.encode_ordinary, full.encode_ordinary, Tokenizer.from_file(path)


def encode(text: str, path: str) -> list[int]:
    """Ids as the tokenizers library gives them for the vocabulary file, without special tokens.

    Common texts go through a faster library that holds the same vocabulary.
    """
    single, full, whole = _encoders(path)
    if _COMMON.search(text):
        return whole.encode(text, add_special_tokens=False).ids
    return full(text) if _SPACES.search(text) else single(text)


def token_pieces(
    docs: DataFrame,
    path: str,
    window: int = 1024,
    part: int = 256,
    end_id: int = 0,
    with_ids: bool = False,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of the pieces of every row.

    Whole windows come first, the rest is cut into parts of at most `part` ids. A
    null text counts as empty and has the closing id only; repeated rows are each
    cut, with the same ids and starts.
    """
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "", path)
                ids.append(end_id)
                ids = np.array(ids, dtype="<u4")
                n = len(ids)
                whole = n - n % window
                cuts = [*range(0, whole, window), *range(whole, n, part), n]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    row = (doc_id, a, b - a, zlib.crc32(ids[a:b].tobytes()), n)
                    out.append((*row, ids[a:b].astype(np.int32)) if with_ids else row)
                if len(out) >= 20_000:
                    yield _piece_batch(out, with_ids)
                    out = []
            if out:
                yield _piece_batch(out, with_ids)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(work, schema)


def _piece_batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
    if with_ids:
        arrays.append(pa.array(columns[5], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *["ids"] * with_ids])


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each size, by the largest differencing method."""
    n = len(sizes)
    parent = np.arange(n)
    first = np.zeros(k, np.int64)
    heap: list[tuple[int, int]] = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    # A partial partition: sums in descending order, and a member of each window or -1.
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    made = n

    def partition(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i in known:
            return known.pop(i)
        sums, members = first.copy(), np.full(k, -1)
        sums[0], members[0] = sizes[i], i
        return sums, members

    while len(heap) > 1:
        a_sums, a = partition(heapq.heappop(heap)[1])
        b_sums, b = partition(heapq.heappop(heap)[1])
        sums, b = a_sums + b_sums[::-1], b[::-1]
        both = (a >= 0) & (b >= 0)
        parent[b[both]] = a[both]
        members = np.where(a >= 0, a, b)
        order = np.argsort(-sums, kind="stable")
        sums, members = sums[order], members[order]
        known[made] = sums, members
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), made))
        made += 1
    _, members = partition(heap[0][1])
    while True:
        further = parent[parent]
        if (further == parent).all():
            break
        parent = further
    window = np.empty(n, np.int64)
    used = np.flatnonzero(members >= 0)
    window[members[used]] = used
    return window[parent]


def fill_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """A window for each size, none over capacity; their number is as small as differencing allows."""
    if len(sizes) == 0:
        return np.zeros(0, np.int64)
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, weights=sizes, minlength=k).max() <= capacity:
            return window
        k += 1


def assign_windows(pieces: DataFrame, window: int = 1024) -> DataFrame:
    """pieces with sequence_id and offset; `pieces` must give the same rows whenever read.

    `_piece`, a number of its own for each row, is stored with the pieces and left out of
    the result. A lot takes the rows whose number hashes to it, so that no id fills a
    lot; the number of lots follows the number of pieces.
    An empty table gives an empty result.
    """
    ship(pieces.sparkSession)
    lots = max(1, pieces.count() // LOT_PARTS)
    kept = [f for f in pieces.schema if f.name != "_piece"]
    names = [*(f.name for f in kept), "sequence_id", "offset"]

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lot = table.column("_lot")[0].as_py()
        table = table.drop_columns(["_lot"]).sort_by([(c, "ascending") for c in ("doc_id", "start", "_piece")])
        sizes = table.column("length").to_numpy()
        whole = sizes == window
        place = np.empty(len(sizes), np.int64)
        place[~whole] = fill_windows(sizes[~whole], window)
        _, place[~whole] = np.unique(place[~whole], return_inverse=True)
        used = int(place[~whole].max()) + 1 if (~whole).any() else 0
        place[whole] = used + np.arange(whole.sum())
        order = np.argsort(place, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        start = np.flatnonzero(np.append(True, place[order][1:] != place[order][:-1]))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - np.repeat(before[start], np.diff(np.append(start, len(sizes))))
        table = table.append_column("sequence_id", pa.array(lot * (1 << 32) + place))
        return table.append_column("offset", pa.array(offset)).select(names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    lot = F.pmod(F.xxhash64("_piece"), F.lit(lots))
    return pieces.withColumn("_lot", lot).groupBy("_lot").applyInArrow(work, f"{fields}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    path: str,
    window: int = 1024,
    part: int = 256,
    end_id: int = 0,
    with_ids: bool = False,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of all rows of docs with their place: see `token_pieces`, `assign_windows`.

    Every id lies in one piece, every window holds at most `window` ids, offsets in
    a window have no gaps. Null and empty texts give one piece with the closing id.
    Rows with a null or repeated id are packed like others. Other columns are
    ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = scratch_path(spark, "pieces")
    cut = token_pieces(docs, path, window, part, end_id, with_ids, id_col=id_col, text_col=text_col)
    cut.withColumn("_piece", F.monotonically_increasing_id()).write.parquet(scratch)
    return assign_windows(spark.read.parquet(scratch), window)


def sequences(packed: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_ids) from packed pieces with ids: padded to `window` unless a power of two long."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    n = F.size("ids")
    exact = n.bitwiseAND(n - 1) == 0
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.when(exact, 0).otherwise(window - n)))
    return rows.select("sequence_id", ids.alias("ids")).select("sequence_id", padded.alias("ids"), n.alias("n_ids"))
