"""The operators as queries over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    centroids,
    embedding_dedup,
    jaccard_join,
    line_dedup,
    packing,
    perspectives,
    pieces,
    quality_model,
    repetition,
    sql,
    toxicity,
    url_filter,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The rules that op11's contract states.
URL_RULES = [
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(_table(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.drop("ids")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~quality_model.held_out(F.col("doc_id"))))
    return toxicity.severity(docs, model)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = perspectives.render(perspectives.segments(_table(spark, sf_dir, "conversations")))
    return perspectives.digest_texts(texts)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs, report="lines").select(
        "doc_id", "lines.n_lines", "lines.n_removed", F.md5("text").alias("text_md5")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(_table(spark, sf_dir, "documents")).drop("longest_repeat")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(centroids.cluster(_table(spark, sf_dir, "embeddings")))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(_table(spark, sf_dir, "documents"), a, b)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_ngram_jaccard_join,
        op3_sentencepiece,
        op4_toxicity,
        op5_warc,
        op6_packing,
        op7_quality_classifier,
        op8_chat_formatting,
        op9_line_dedup,
        op10_quality_rules,
        op11_url_filters,
        op12_centroid_clustering,
        op13_tokenizer_alignment,
    )
}
SQL: dict[str, str] = {k: v for k, v in sql.SQL.items() if k in QUERIES}
