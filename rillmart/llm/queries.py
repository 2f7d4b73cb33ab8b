"""The queries opN_<name>, each over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    centroids,
    fingerprints,
    langid,
    lm,
    mixing,
    neighbours,
    ngram_join,
    passages,
    quality,
    resampling,
    toxicity,
    urls,
)
from .frames import ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return f(ready(spark), sf)

    QUERIES[f.__name__] = run
    return run


@query
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return urls.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passages.shared_passages(spark.read.parquet(f"{sf}/documents.parquet")).select(
        "doc_id", "start", "end", "other_id", "other_start", "other_end", "equal")


@query
def op4_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark, 4096)
    return neighbours.neighbours(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


@query
def op5_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return ngram_join.jaccard_components(docs, k=3, least=90).select("doc_id", "n_shingles", "component_id")


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels, remainder(5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op7_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edit_likeness(spark.read.parquet(f"{sf}/documents.parquet"))


@query
def op8_language_model(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark, 64)
    return lm.score(spark.read.parquet(f"{sf}/documents.parquet"), remainder(5) != 1)


@query
def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return langid.predict(docs, langid.train(docs, remainder(4) != 2)).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampling.importance_ranks(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judged(spark.read.parquet(f"{sf}/documents.parquet")).select(
        "doc_id", *quality.MEASURES, "base_failed", "kept", "removed_words")


@query
def op13_centroid_clusters(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark, 4096)
    return centroids.cluster_report(spark.read.parquet(f"{sf}/embeddings.parquet"))
