"""From raw documents to packed sequences: five stages, each written and read again.

All stages but the last return the columns of documents, extra ones included and
whatever their names. An empty table passes through all of them as an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillmetrics.llm import jaccard_join, line_dedup, packing, repetition, toxicity
from tillmetrics.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from the labelled ones of its input.

    Every row is judged by its own text, so equal rows fare alike and rows that share
    an id may not. Null and empty texts hold no toxic language and stay. Without
    toxic labels all documents stay.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules.

    Every row is judged by its own text. Null and empty texts, and all with fewer than
    ten words, fail the base rule and go.
    """
    return repetition.drop_repetitive(docs)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share; n_chars follows the text.

    A shared line stays in the document with the smallest id, so a document whose
    lines all stand in earlier ones is left with an empty text. Null texts stay null,
    a null source counts as no site.
    """
    return line_dedup.with_length(line_dedup.remove_boilerplate(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Of repeated rows one stays. Texts without words are no copies of each other: one
    row stays per id. Rows with a null id all stay.
    """
    return jaccard_join.keep_one(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in windows of 1024 tokens.

    Null and empty texts have one piece, the closing id. Rows with a null or repeated
    id are packed like others.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_repetitive),
    ("line_dedup", drop_boilerplate_lines),
    ("near_copies", drop_near_copies),
    ("packing", pack_windows),
]

#: A fitted model and the differencing of windows cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each result is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
