"""Cross-site boilerplate lines, by the spread of each line over distinct sites.

One HyperLogLog sketch of the sites per line, merged by Spark's aggregation.
Lines whose estimate is near the threshold get an exact distinct count. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.session import scratch_path

#: log2 of the sketch's registers; its relative error is about 1.04 / sqrt(2**12).
SKETCH_BITS = 12
#: Sites from which a line counts as boilerplate: copies of two to four documents stand
#: on fewer; 12 documents drawn where one site of 20 holds a third nearly always reach 5.
MIN_SITES = 5
#: Estimates within this share of the threshold are counted exactly (over 10 standard errors).
NEAR = 0.25


def line_key(line: Column) -> Column:
    """96 bits of a line without blanks at its ends."""
    bare = F.trim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"))


def _has_text(line: Column) -> Column:
    return F.length(F.trim(line, F.lit(" \t\r"))) > 0


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(key, first_doc) of the lines on at least `min_sites` distinct sites.

    lines: (key, doc_id, site), one row per line, or one per line and text. A
    null site counts for none.
    """
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min("doc_id").alias("first_doc")
    )
    estimated = sketched.select("key", "first_doc", F.hll_sketch_estimate("sketch").alias("sites")).filter(
        F.col("sites") >= min_sites * (1 - NEAR)
    )
    sure = estimated.filter(F.col("sites") > min_sites * (1 + NEAR)).select("key", "first_doc")
    near = estimated.filter(F.col("sites") <= min_sites * (1 + NEAR)).select("key", "first_doc")
    exact = (
        lines.select("key", "site")
        .join(near.select("key"), "key", "left_semi")
        .distinct()
        .groupBy("key")
        .agg(F.count("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    return sure.unionByName(near.join(exact.select("key"), "key", "left_semi"))


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    keep_first: bool = True,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    report: str | None = None,
) -> DataFrame:
    """docs with the lines taken out that stand on `min_sites` sites or more.

    Lines are split at "\\n" and compared without blanks at their ends; lines
    without text always stay. With `keep_first` a line stays in the document with
    the smallest id that holds it, so that its content is not lost; a document
    whose lines all stand elsewhere is left with an empty text. `report` names an
    added column struct<n_lines, n_removed>.

    Null texts stay null with no lines; null sites add nothing to a line's spread,
    their lines are still removed. Null ids are never the smallest unless all are
    null. Repeated rows and ids are each cleaned; rows with the smallest id all
    keep the line. Other columns pass through untouched whatever their names. An
    empty table gives an empty result.
    """
    split = F.split(F.col("text"), "\n", -1)
    work = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(site_col).alias("site")
    ).select("doc_id", F.xxhash64("text").alias("version"), "site", F.explode(F.array_distinct(split)).alias("line"))
    lines = work.filter(_has_text(F.col("line"))).select("doc_id", "version", "site", line_key(F.col("line")).alias("key"))
    path = scratch_path(docs.sparkSession, "spread_lines")
    spread_lines(lines.select("key", "doc_id", "site"), min_sites).write.parquet(path)
    # Read as a table of its own, so that Spark can split the lines of a very common key in the join.
    spread = docs.sparkSession.read.parquet(path)
    hits = lines.select("doc_id", "version", "key").join(spread, "key")
    if keep_first:
        hits = hits.filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    # A set per document and text: no more keys than the text has lines.
    per_doc = hits.groupBy("doc_id", "version").agg(F.collect_set("key").alias("_drop"))
    per_doc = per_doc.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "_drop")
    parts = F.split(F.col(f"_doc.`{text_col}`"), "\n", -1)
    left = F.filter(parts, lambda x: ~(_has_text(x) & F.array_contains(F.col("_drop"), line_key(x))))
    whole = docs.select(F.struct("*").alias("_doc"))
    joined = whole.join(
        per_doc,
        F.col(f"_doc.`{id_col}`").eqNullSafe(F.col("_id"))
        & (F.xxhash64(F.col(f"_doc.`{text_col}`")) == F.col("_version")),
        "left",
    )
    cleaned = joined.select(
        "_doc", F.when(F.col("_drop").isNull(), F.col(f"_doc.`{text_col}`")).otherwise(F.array_join(left, "\n")).alias("_text"),
        F.coalesce(F.size(F.when(F.col("_drop").isNotNull(), left)), F.size(parts)).alias("_left"),
    )
    columns = [F.col("_text").alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    if report:
        n = F.when(F.col(f"_doc.`{text_col}`").isNull(), 0).otherwise(F.size(parts)).cast("long")
        removed = F.when(F.col(f"_doc.`{text_col}`").isNull(), 0).otherwise(F.size(parts) - F.col("_left")).cast("long")
        columns.append(F.struct(n.alias("n_lines"), removed.alias("n_removed")).alias(report))
    return cleaned.select(columns)


def with_length(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with its length column, where it has one, set to the length of the text."""
    if length_col not in docs.columns:
        return docs
    return docs.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
