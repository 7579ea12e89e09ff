"""Similarity join on word n-grams by chosen paths.

Sets are split on sampled tokens they share: in a run, a set goes to the bucket
of every token whose hash falls below a bound that shrinks with the set's size.
Buckets above a limit are split again on further sampled tokens of the path's
own hash; small ones are compared by brute force. `RUNS` samples per set stand
for as many runs: a pair at the threshold meets with probability above 1 - 1e-6
at the first level. Where all its buckets are split, each split repeats its
sampling as often as it takes for the pair to be lost with a computed probability
of at most `MISS`. Inside buckets sets are compared by one-permutation sketches
(cut four standard errors below the threshold), and only a spanning forest of
the likely links leaves a task. Loosely connected sets then meet once, with
their whole texts, and every link between them is counted exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.session import scratch_path

from .arrays import TextBlock, mix, text_blocks, window_hashes
from .graph import components, forest
from .ship import ship

#: Expected samples of a set at the first level, one per run.
RUNS = 16
#: Sampled tokens a set keeps for the levels below.
TOKENS = 48
#: How often a pair at the threshold may be lost where every bucket it shares is split at every level.
MISS = 1e-4
LEVELS = 3
#: Buckets up to this size are compared by brute force at once.
SMALL_BUCKET = 200
SKETCH_BINS = 256
#: Rows that are compared in one group, about; a bucket or pair of blocks more at most.
LOT_ROWS = 4000
#: Sets per block where a bucket is still large after the last split.
BLOCK = 512
#: Sets that meet in one task when links are counted.
COUNT_BLOCK = 1024


def shingle_sets(block: TextBlock, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash), distinct and in order: all windows of `words` words of each row."""
    starts, ends = block.words()
    hashes, bounds = window_hashes(block.span_hashes(starts, ends), block.row_bounds(starts), words)
    row = np.repeat(np.arange(block.rows), np.diff(bounds))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    return row[new], hashes[new]


def sketches(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """rows x SKETCH_BINS bytes: 1..255 from each bin's smallest hash, 0 for an empty bin."""
    bins = (hashes >> np.uint64(56)).astype(np.int64)
    slot = row * SKETCH_BINS + bins
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]
    out = np.zeros(rows * SKETCH_BINS, np.uint8)
    out[slot[first]] = (mix(hashes[first]) % np.uint64(255)).astype(np.uint8) + 1
    return out.reshape(rows, SKETCH_BINS)


def likely(a: np.ndarray, b: np.ndarray, threshold: float, errors: float = 4.0) -> np.ndarray:
    """Whether sketches a and b (n x bins) may belong to sets at the threshold."""
    filled = ((a | b) != 0).sum(-1)
    equal = ((a == b) & (a != 0)).sum(-1)
    m = np.maximum(filled, 1)
    return equal / m >= threshold - errors * np.sqrt(threshold * (1 - threshold) / m)


def _profiles(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, s1, s2, n, sketch, tokens) of rows with an id and at least one word."""
    ship(docs.sparkSession)
    names = ["doc_id", "s1", "s2", "n", "sketch", "tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, block in text_blocks(batch.column(1)):
                row, hashes = shingle_sets(block, words)
                bounds = np.searchsorted(row, np.arange(block.rows + 1))
                n = np.diff(bounds)
                have = np.flatnonzero(n)
                if len(have) == 0:
                    continue
                s1 = np.add.reduceat(mix(hashes ^ np.uint64(0x51ED)), bounds[have])
                s2 = np.add.reduceat(mix(hashes ^ np.uint64(0xA3C7)), bounds[have])
                draw = (mix(hashes ^ np.uint64(0x7F4A)) >> np.uint64(11)).astype(np.float64) / 2.0**53
                taken = np.flatnonzero(draw * n[row] < TOKENS)
                # The smallest draws first, so that the first level's samples lead.
                taken = taken[np.lexsort((draw[taken], row[taken]))]
                cuts = np.searchsorted(row[taken], np.append(have, block.rows))
                sketch = sketches(row, hashes, block.rows)[have]
                runs = np.bincount(row[draw * n[row] < RUNS], minlength=block.rows)[have]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo).take(pa.array(have)),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.array(n[have].astype(np.int32)),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(hashes[taken].view(np.int64))),
                        pa.array(runs.astype(np.int32)),
                    ],
                    names=[*names, "first"],
                )

    schema = "doc_id long, s1 long, s2 long, n int, sketch binary, tokens array<long>, first int"
    return docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(work, schema)


def _bucket_edges(threshold: float):
    """Edges (a, b) of a spanning forest of the likely links in every bucket of a group."""

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bucket = table.column("bucket").to_numpy()
        rep = table.column("rep").to_numpy()
        order = np.lexsort((rep, bucket))
        bucket, rep = bucket[order], rep[order]
        sketch = np.frombuffer(b"".join(table.column("sketch").take(pa.array(order)).to_pylist()), np.uint8)
        sketch = sketch.reshape(len(rep), SKETCH_BINS)
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(first, len(bucket)))
        found_a, found_b = [], []
        for count in np.unique(size):
            if count < 2:
                continue
            starts = first[size == count]
            if count <= 16:
                # Buckets of one size together: all pairs of places in a bucket.
                for i in range(count - 1):
                    for j in range(i + 1, count):
                        for at in range(0, len(starts), 4096):
                            s = starts[at : at + 4096]
                            hit = likely(sketch[s + i], sketch[s + j], threshold)
                            found_a.append(s[hit] + i)
                            found_b.append(s[hit] + j)
            else:
                for s in starts:
                    for i in range(count - 1):
                        hit = np.flatnonzero(likely(sketch[s + i], sketch[s + i + 1 : s + count], threshold))
                        found_a.append(np.full(len(hit), s + i))
                        found_b.append(hit + s + i + 1)
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        # One number per set of the group, so that the forest spans its buckets.
        nodes, at = np.unique(rep, return_inverse=True)
        root = forest(at[a], at[b], len(nodes))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.table({"a": nodes[moved], "b": nodes[root[moved]]})

    return work


def _count_links(threshold: float, words: int):
    """Exact links in the buckets of a group: (node, links, root).

    A bucket is a whole component, or two blocks of a large one; then `side` says
    which block a row is in and only links between the blocks (or within the one)
    are counted.
    """

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bucket = table.column("bucket").to_numpy()
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        node = table.column("node").to_numpy()[order]
        copies = table.column("copies").to_numpy()[order]
        side = table.column("side").to_numpy()[order]
        texts = table.column("text").take(pa.array(order)).combine_chunks()
        rows, hashes = [], []
        for lo, _, block in text_blocks(texts):
            r, h = shingle_sets(block, words)
            rows.append(r + lo)
            hashes.append(h)
        row, token = np.concatenate(rows), np.concatenate(hashes)
        bounds = np.searchsorted(row, np.arange(len(node) + 1))
        links = np.zeros(len(node), np.int64)
        root = node.copy()
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for lo, hi in zip(first, np.append(first[1:], len(bucket)), strict=True):
            a, b = linked_pairs(row[bounds[lo] : bounds[hi]] - lo, token[bounds[lo] : bounds[hi]], hi - lo, threshold)
            a, b = a + lo, b + lo
            two = side[lo:hi].any()
            use = (node[a] != node[b]) & ((side[a] != side[b]) if two else True)
            a, b = a[use], b[use]
            # Rows that share an id count as one node: a pair of nodes once.
            if len(np.unique(node[lo:hi])) < hi - lo:
                _, once = np.unique(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b])]), axis=1, return_index=True)
                a, b = a[once], b[once]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            nodes, at = np.unique(node[lo:hi], return_inverse=True)
            local = forest(at[a - lo], at[b - lo], len(nodes))
            root[lo:hi] = nodes[local][at]
        return pa.table({"node": node, "links": links, "root": root})

    return work


def linked_pairs(row: np.ndarray, token: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs a < b of n sets with Jaccard >= threshold, through a matrix of shared tokens."""
    sizes = np.bincount(row, minlength=n)
    distinct, at, times = np.unique(token, return_inverse=True, return_counts=True)
    shared = times[at] > 1
    columns, at = np.unique(at[shared], return_inverse=True)
    row = row[shared]
    common = np.zeros((n, n), np.float32)
    for lo in range(0, len(columns), 4096):
        part = (at >= lo) & (at < lo + 4096)
        ones = np.zeros((n, min(4096, len(columns) - lo)), np.float32)
        ones[row[part], at[part] - lo] = 1
        common += ones @ ones.T
    union = sizes[:, None] + sizes[None, :] - common
    a, b = np.nonzero(np.triu(common >= threshold * union - 1e-6, 1))
    # float32 holds the counts exactly up to 2**24; the last word is a comparison of whole numbers.
    exact = common[a, b].astype(np.int64) * 1_000_000 >= int(round(threshold * 1_000_000)) * union[a, b].astype(np.int64)
    return a[exact], b[exact]


def split_miss(size: int, bound: float, threshold: float) -> float:
    """Probability that no path shared by a pair at the threshold lasts to the last level.

    size: kept tokens of the larger set; the other one may lie inside it, so the pair
    shares a `threshold` of them. bound: the share of tokens that are children.
    """
    shared = int(np.ceil(threshold * size - 1e-9))
    lost = 0.0
    for _ in range(LEVELS - 1):
        lost = (1 - bound + bound * lost) ** shared
    first = min(1.0, RUNS / size)
    return (1 - first + first * lost) ** shared


def child_bounds(threshold: float, miss: float = MISS) -> list[float]:
    """For sets of 1, 2, .. `TOKENS` kept tokens the share of them that are children in a split.

    The smallest in steps of a quarter child that keeps `split_miss` below the target.
    """
    bounds = []
    for size in range(1, TOKENS + 1):
        steps = np.minimum(1.0, np.arange(4, 4 * size + 4) / (4 * size))
        bounds.append(float(next((b for b in steps if split_miss(size, b, threshold) <= miss), 1.0)))
    return bounds


def _unit(value: Column) -> Column:
    """0 <= x < 1 from a 64-bit hash."""
    return F.shiftrightunsigned(value, 11).cast("double") / F.lit(float(1 << 53))


def candidate_edges(reps: DataFrame, threshold: float, scratch: str) -> DataFrame:
    """Edges (a, b) that connect every two representatives likely to be linked.

    reps: (rep, sketch, tokens, first), one row per set.
    """
    spark = reps.sparkSession
    light = reps.select("rep", F.explode(F.slice("tokens", 1, F.greatest("first", F.lit(1)))).alias("path"))
    edges = None
    bounds = F.array(*[F.lit(b) for b in child_bounds(threshold)])

    def add(found: DataFrame) -> None:
        nonlocal edges
        edges = found if edges is None else edges.unionByName(found)

    def compare(rows: DataFrame, count: int) -> DataFrame:
        """rows: `count` of (bucket, rep, sketch); buckets stay whole in a group of buckets."""
        lots = max(1, count // LOT_ROWS)
        return rows.withColumn("lot", F.pmod(F.xxhash64("bucket"), F.lit(lots))).groupBy("lot").applyInArrow(
            _bucket_edges(threshold), "a long, b long"
        )

    for level in range(1, LEVELS + 1):
        sizes = light.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        with_sizes = light.join(sizes, "path")
        path = f"{scratch}/level{level}"
        # Of a set's tokens only its children in a large bucket go along, two or three for most.
        bound = F.element_at(bounds, F.least(F.size("tokens"), F.lit(TOKENS))) * F.least(F.size("tokens"), F.lit(TOKENS))
        chosen = F.filter("tokens", lambda t: _unit(F.xxhash64("path", t)) < bound / F.size("tokens"))
        children = F.transform(chosen, lambda t: F.xxhash64(t, "path"))
        split = (F.col("size") > SMALL_BUCKET) if level < LEVELS else F.lit(False)
        with_sizes.join(reps.select("rep", "sketch", "tokens"), "rep").select(
            "path", "size", "rep", "sketch", F.when(split, children).alias("children")
        ).write.parquet(path)
        rows = spark.read.parquet(path)
        total = rows.agg(
            F.count(F.when(F.col("size") <= SMALL_BUCKET, 1)), F.count(F.when(F.col("size") > SMALL_BUCKET, 1))
        ).first()
        small = rows.filter(F.col("size") <= SMALL_BUCKET).select(F.col("path").alias("bucket"), "rep", "sketch")
        add(compare(small, total[0]))
        if total[1] == 0:
            break
        # Large buckets: whatever is close to the bucket's leader is done with.
        large = rows.filter(F.col("size") > SMALL_BUCKET)
        leaders = large.groupBy("path").agg(
            F.min("rep").alias("leader"), F.min_by("sketch", "rep").alias("leader_sketch")
        )
        near_path = f"{scratch}/near{level}"
        large.join(leaders, "path").withColumn(
            "near", _nearness(threshold)(F.col("sketch"), F.col("leader_sketch"))
        ).drop("leader_sketch").write.parquet(near_path)
        judged = spark.read.parquet(near_path)
        # Only where the leader stands for most of its bucket; elsewhere all go on.
        dense = judged.filter("near = 2").groupBy("path", "size").agg(F.count("*").alias("core"))
        dense.filter("core * 2 >= size").select("path").write.parquet(f"{scratch}/dense{level}")
        # A table of known size: where it is small, the hot buckets' rows need no shuffle.
        dense = spark.read.schema("path long").parquet(f"{scratch}/dense{level}")
        settled = judged.filter("near > 0 and rep != leader").join(dense, "path", "left_semi")
        add(settled.select(F.col("rep").alias("a"), F.col("leader").alias("b")))
        rest = judged.filter("near < 2").unionByName(judged.filter("near = 2").join(dense, "path", "left_anti"))
        if level < LEVELS:
            light = rest.select("rep", F.explode("children").alias("path"))
            light.distinct().write.parquet(f"{scratch}/split{level}")
            light = spark.read.parquet(f"{scratch}/split{level}")
        else:
            add(_block_pairs(rest, compare, f"{scratch}/last"))
    return edges


def _nearness(threshold: float):
    """2: core, within 1.5 times the link distance of the leader; 1: perhaps linked to a core set; 0: neither.

    Jaccard distance is a metric: what links with a core set is within 2.5 times
    the link distance of the leader, so the core needs no other comparison.
    """
    reach = 1 - threshold

    @F.pandas_udf("int")
    def nearness(sketch, leader):
        a = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(sketch), SKETCH_BINS)
        b = np.frombuffer(b"".join(leader), np.uint8).reshape(len(leader), SKETCH_BINS)
        core = likely(a, b, 1 - 1.5 * reach, 0.0)
        border = likely(a, b, 1 - 2.5 * reach)
        return pd.Series(np.where(core, 2, np.where(border, 1, 0)).astype(np.int32))

    return nearness


def _block_pairs(rest: DataFrame, compare: Callable[[DataFrame, int], DataFrame], scratch: str) -> DataFrame:
    """All of a bucket that is still large after the last split, in pairs of blocks.

    The pairs of blocks are counted from the buckets' sizes and dealt into lots by that count.
    """
    rest.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1").write.parquet(scratch)
    sizes = rest.sparkSession.read.schema("path long, size long").parquet(scratch)
    count = sizes.agg(F.coalesce(F.sum(F.col("size") * F.ceil(F.col("size") / BLOCK)), F.lit(0))).first()[0]
    rows = rest.select("path", "rep", "sketch").join(sizes, "path")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep"), blocks.cast("long")).cast("int")
    rows = rows.select("path", "rep", "sketch", blocks.alias("blocks"), mine.alias("mine"))
    rows = rows.select("path", "rep", "sketch", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pair = F.xxhash64("path", F.least("mine", "other"), F.greatest("mine", "other"))
    return compare(rows.select(pair.alias("bucket"), "rep", "sketch"), count)


def jaccard_classes(
    docs: DataFrame,
    threshold: float = 0.8,
    words: int = 5,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, class_id, n_links, component_id, kept), one row per row of docs.

    Texts are compared as sets of their windows of `words` words (lower case, split
    at white space); a text with fewer words has one window of all of them. Rows
    with equal sets form a class, class_id is its smallest id. n_links: other
    rows whose set has a Jaccard similarity of `threshold` or more.
    component_id: the smallest id reachable by links. kept: doc_id = component_id.

    Null, empty and wordless texts link with nothing, and so do rows with a null id
    (class_id and component_id are then null, kept is true). Repeated rows are
    copies of each other; rows that share an id but not the text are one component.
    Other columns are ignored.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = scratch_path(spark, "jaccard")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    _profiles(base, words).write.parquet(f"{scratch}/profiles")
    profiles = spark.read.parquet(f"{scratch}/profiles")
    profiles.groupBy("s1", "s2", "n").agg(
        F.min("doc_id").alias("rep"),
        F.count("*").alias("copies"),
        F.min_by(F.struct("sketch", "tokens", "first"), "doc_id").alias("own"),
    ).select("s1", "s2", "n", "rep", "copies", "own.*").write.parquet(f"{scratch}/classes")
    classes = spark.read.parquet(f"{scratch}/classes")
    loose = candidate_edges(classes.select("rep", "sketch", "tokens", "first"), threshold, scratch)
    loose.write.parquet(f"{scratch}/loose")
    groups = components(spark.read.parquet(f"{scratch}/loose"))
    counted = _exact(base, classes, groups, threshold, words, scratch)
    per_class = (
        classes.select("s1", "s2", "n", "rep", "copies")
        .join(counted, F.col("rep") == F.col("node"), "left")
        .select(
            "s1",
            "s2",
            "n",
            "rep",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    linked = profiles.select("doc_id", "s1", "s2", "n").join(per_class, ["s1", "s2", "n"]).select(
        "doc_id", F.col("rep").alias("class_id"), "n_links", "component_id"
    )
    bare = base.filter(F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    alone = bare.select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id")
    )
    both = linked.unionByName(alone)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _exact(
    base: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, words: int, scratch: str
) -> DataFrame:
    """(node, links, component) of every representative in a loose component."""
    spark = base.sparkSession
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = groups.join(sizes, "component").join(classes.select(F.col("rep").alias("node"), "copies"), "node")
    texts = base.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("node"), "text")
    # One text of each representative; rows that share its id bring theirs as well.
    # Joined by sorting whatever the size, so that its cost follows the input.
    chosen = members.groupBy("node", "component", "size").agg(F.max("copies").alias("copies"))
    chosen.join(texts.hint("merge"), "node").dropDuplicates(["node", "text"]).write.parquet(f"{scratch}/members")
    rows = spark.read.parquet(f"{scratch}/members")
    blocks = F.ceil(F.col("size") / COUNT_BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    spread = rows.select("node", "component", "copies", "text", blocks.alias("blocks"), mine.alias("mine")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    total = spread.agg(F.count("*")).first()[0]
    lots = max(1, total // 1500)
    one = F.col("blocks") == 1
    lot = F.when(one, F.pmod(F.xxhash64("component"), F.lit(lots))).otherwise(
        F.lit(lots) + F.pmod(F.xxhash64("component", low, high), F.lit(1 << 40))
    )
    bucket = F.xxhash64("component", low, high)
    parts = (
        spread.select(
            lot.alias("lot"),
            bucket.alias("bucket"),
            "node",
            "copies",
            F.when((low != high) & (F.col("mine") == high), 1).otherwise(0).alias("side"),
            "text",
        )
        .groupBy("lot")
        .applyInArrow(_count_links(threshold, words), "node long, links long, root long")
    )
    parts.write.parquet(f"{scratch}/parts")
    parts = spark.read.parquet(f"{scratch}/parts")
    links = parts.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return links.join(found, "node", "left").select("node", "links", F.coalesce("component", "node").alias("component"))


def keep_one(
    docs: DataFrame, threshold: float = 0.8, words: int = 5, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of docs, all columns, with one document of each component of `jaccard_classes`.

    The one with the smallest id stays; of rows that share it, the first by text.
    Rows with a null id all stay, and so do rows without words, once per id.
    """
    ids = jaccard_classes(docs, threshold, words, id_col=id_col, text_col=text_col)
    ids = ids.filter("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    whole = docs.select(F.struct("*").alias("_doc"))
    key = F.col(f"_doc.`{id_col}`")
    first = Window.partitionBy("_kept_id").orderBy(F.col(f"_doc.`{text_col}`"))
    named = whole.join(ids, key == F.col("_kept_id")).withColumn("_place", F.row_number().over(first))
    kept = named.filter("_place = 1").select("_doc")
    return kept.unionByName(whole.filter(key.isNull())).select("_doc.*")
