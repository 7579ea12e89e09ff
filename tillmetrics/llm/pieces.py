"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text is cut into chunks no piece can cross: a run of spaces with the word after
it. Distinct chunks of one length advance together: at each end position the
hashes of all substrings that end there probe the sorted piece keys, and a
vectorised maximum keeps the best predecessor. Chunks a task has met before are
looked up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import TextBlock, text_blocks
from .ship import ship

#: The space mark of the pieces; a text's own mark reads as a space, as in the library.
MARK = "▁"
#: An unknown character scores this much below the worst piece (fixed by the library).
UNKNOWN_PENALTY = 10.0
#: Distinct chunks a task remembers; beyond it starts anew.
REMEMBERED = 400_000
#: Longest chunk that is grouped with others of its length.
GROUPED_BYTES = 512
#: Substrings scored at once.
SCORED = 1 << 20


class Pieces:
    """The vocabulary: sorted hashes of the piece texts (mark as space), ids, scores."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        texts: list[bytes] = [b""] * n
        self.unknown_id = model.unk_id()
        normal, self.byte_ids = [], np.full(256, self.unknown_id, np.int64)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], texts[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                texts[i] = piece.replace(MARK, " ").encode()
                normal.append(i)
        ids = np.array(normal)
        scores = np.array([model.get_score(int(i)) for i in ids])
        keys = _hashes([texts[i] for i in normal])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids, self.scores = keys[order], ids[order], scores[order]
        self.unknown = float(scores.min()) - UNKNOWN_PENALTY
        self.longest = max(len(texts[i]) for i in normal)
        if any(b" " in texts[i].lstrip(b" ") for i in normal):
            raise ValueError("a piece has a space after another character")
        used = np.zeros(256, bool)
        used[np.frombuffer(b"".join(texts[i] for i in normal), np.uint8)] = True
        #: ASCII characters that are in no piece stand alone in any segmentation.
        self.lonely = ~used & (np.arange(256) < 128)
        self.text_starts = np.zeros(n + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.text_starts[1:])
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)


def _hashes(texts: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(t) for t in texts])
    block = TextBlock(np.frombuffer(b"".join(texts), np.uint8), np.append(0, ends))
    return block.span_hashes(block.offsets[:-1], block.offsets[1:])


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the runs starts[i] .. starts[i] + counts[i], back to back."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def chunks(block: TextBlock, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the chunks of every text of a block."""
    data = block.data
    space, lonely = data == 32, pieces.lonely[data] & (data != 32)
    cut = np.zeros(len(data), bool)
    cut[1:] = (space[1:] & ~space[:-1]) | lonely[1:] | lonely[:-1]
    filled = block.offsets[1:] > block.offsets[:-1]
    cut[block.offsets[:-1][filled]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(block.offsets, starts, "right") - 1


def _segment(
    block: TextBlock, starts: np.ndarray, length: int, pieces: Pieces, char_start: np.ndarray, chars: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Best segmentation of the spans of `length` bytes at `starts`: (ids, count per span).

    char_start, chars: where characters of the block begin, and how many before each byte.
    """
    n, longest = len(starts), min(pieces.longest, length)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, length + 1), np.int32)
    piece = np.full((n, length + 1), -1, np.int64)
    for end in range(1, length + 1):
        # Longest substring first, so that a tie goes to it.
        begins = np.arange(max(0, end - longest), end)
        s = starts[:, None] + begins[None, :]
        e = np.broadcast_to(starts[:, None] + end, s.shape)
        keys = block.span_hashes(s.ravel(), e.ravel())
        at = np.minimum(np.searchsorted(pieces.keys, keys), len(pieces.keys) - 1)
        known = (pieces.keys[at] == keys).reshape(s.shape)
        at = at.reshape(s.shape)
        one = (chars[e] - chars[s] == 1) & char_start[s]
        if end < length:
            one &= char_start[e]
        score = np.where(known, pieces.scores[at], np.where(one, pieces.unknown, -np.inf))
        total = best[:, begins] + score
        pick = total.argmax(1)
        each = np.arange(n)
        best[:, end] = total[each, pick]
        back[:, end] = begins[pick]
        piece[:, end] = np.where(known[each, pick], pieces.ids[at[each, pick]], -1)
    place = np.full(n, length)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.arange(n)
    while len(live):
        end = place[live]
        begin = back[live, end]
        found.append((live, begin, end, piece[live, end]))
        place[live] = begin
        live = live[begin > 0]
    span = np.concatenate([f[0] for f in found])
    begin = np.concatenate([f[1] for f in found])
    end = np.concatenate([f[2] for f in found])
    ids = np.concatenate([f[3] for f in found])
    order = np.lexsort((begin, span))
    span, begin, end, ids = span[order], begin[order], end[order], ids[order]
    # An unknown character becomes the pieces of its bytes.
    width = np.where(ids < 0, end - begin, 1)
    from_bytes = pieces.byte_ids[block.data[gather(starts[span] + begin, width)]]
    out = np.where(np.repeat(ids < 0, width), from_bytes, np.repeat(ids, width))
    return out, np.bincount(np.repeat(span, width), minlength=n)


class Encoder:
    """Ids of whole blocks of texts; remembers the chunks it has met."""

    def __init__(self, path: str):
        self.pieces = load(path)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = self.counts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int64)

    def _learn(self, block: TextBlock, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        lengths = ends - starts
        new_ids, new_counts, order = [], [], []
        char_start = (block.data & 0xC0) != 0x80
        chars = np.zeros(len(block.data) + 1, np.int64)
        np.cumsum(char_start, out=chars[1:])
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            at_once = max(1, SCORED // (int(length) * 24)) if length <= GROUPED_BYTES else 1
            for lo in range(0, len(own), at_once):
                part = own[lo : lo + at_once]
                ids, counts = _segment(block, starts[part], int(length), self.pieces, char_start, chars)
                new_ids.append(ids)
                new_counts.append(counts)
                order.append(part)
        counts = np.concatenate(new_counts)
        begins = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate([self.flat, *new_ids])
        all_keys = np.concatenate([self.keys, keys[np.concatenate(order)]])
        by = np.argsort(all_keys, kind="stable")
        self.keys = all_keys[by]
        self.starts = np.concatenate([self.starts, begins])[by]
        self.counts = np.concatenate([self.counts, counts])[by]

    def encode(self, block: TextBlock) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts back to back, bounds per text); the texts begin with their added space."""
        starts, ends, row = chunks(block, self.pieces)
        if len(starts) == 0:
            return np.zeros(0, np.int64), np.zeros(block.rows + 1, np.int64)
        keys = block.span_hashes(starts, ends)
        if len(self.keys) > REMEMBERED:
            self._forget()
        distinct, first = np.unique(keys, return_index=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        fresh = np.ones(len(distinct), bool) if len(self.keys) == 0 else self.keys[at] != distinct
        if fresh.any():
            self._learn(block, starts[first[fresh]], ends[first[fresh]], distinct[fresh])
        at = np.searchsorted(self.keys, keys)
        counts = self.counts[at]
        ids = self.flat[gather(self.starts[at], counts)]
        bounds = np.zeros(block.rows + 1, np.int64)
        np.cumsum(np.bincount(row, weights=counts, minlength=block.rows).astype(np.int64), out=bounds[1:])
        return ids, bounds


def decode_bytes(ids: np.ndarray, bounds: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows back to back, bounds); the space before each text is taken off."""
    widths = np.diff(pieces.text_starts)[ids]
    data = pieces.text_bytes[gather(pieces.text_starts[ids], widths)]
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(widths, out=total[1:])
    ends = total[bounds]
    lead = np.zeros(len(data), bool)
    heads = ends[:-1][ends[1:] > ends[:-1]]
    lead[heads] = data[heads] == 32
    drop = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=drop[1:])
    return data[~lead], ends - drop[ends]


def _prepared(column: str) -> Column:
    """A space before every text that has characters, and spaces for marks."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.when(F.length(text) > 0, F.concat(F.lit(" "), F.translate(text, MARK, " "))).otherwise("")


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_ids, ids_crc32, round_trip), one row per row of docs.

    ids: the segmentation with the largest sum of scores (a tie goes to the longer
    last piece), unknown characters as the pieces of their bytes. ids_crc32: of the
    ids as little-endian unsigned 32-bit numbers. round_trip: decoding gives the text
    back, marks read as spaces.

    Null and empty texts have no ids. Repeated rows and ids give one row each; null
    ids stay null. Other columns are ignored. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for lo, hi, block in text_blocks(batch.column(1)):
                ids, bounds = encoder.encode(block)
                data, ends = decode_bytes(ids, bounds, encoder.pieces)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                given, back = block.data.tobytes(), data.tobytes()
                same = [
                    given[block.offsets[i] + 1 : block.offsets[i + 1]] == back[ends[i] : ends[i + 1]]
                    for i in range(block.rows)
                ]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                columns = [batch.column(0).slice(lo, hi - lo), lists, pa.array(np.diff(bounds)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(same)], names=names)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), _prepared(text_col).alias("text"))
    return chosen.mapInArrow(work, "doc_id long, ids array<int>, n_ids long, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) for (doc_id, ids), one row per row.

    Null lists give null, empty ones an empty text. An id that is null, negative or beyond
    the vocabulary adds nothing to the text; bytes that are no UTF-8 give the replacement
    character. Repeated rows give one row each, other columns are ignored.
    An empty table gives an empty result.
    """
    ship(encoded.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            column = batch.column(1)
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(lengths))
            ids = column.flatten().cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            ids = np.where((ids >= 0) & (ids < len(pieces.text_starts) - 1), ids, pieces.unknown_id)
            data, ends = decode_bytes(ids, bounds, pieces)
            raw = data.tobytes()
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
            texts = [t if v else None for t, v in zip(texts, column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    chosen = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"doc_id {kind}, text string")
