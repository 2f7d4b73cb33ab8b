"""The corpus pipeline: five stages, each a Parquet table that the next one reads.

1. toxicity: documents that the classifier rejects go.
2. n-gram Jaccard join: of each group of near-duplicates (five words, similarity 0.8 or more) the document of smallest
   doc_id stays.
3. substring dedup: passages of 50 words or more that repeat an earlier document are taken out.
4. source mix: each document is there as many times as the mix takes it, which may be never.
5. byte-level BPE: the token ids of each text, and a check that they decode to it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm import bpe, mixing, ngram_join, passages, toxicity
from rillmart.llm.frames import ready


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is below 0.5, learnt from ``labels`` and the texts that are there."""
    ready(spark, lean=True)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels), 0.5)


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of smallest doc_id; those without words stay."""
    ready(spark, lean=True)
    return ngram_join.without_near_duplicates(docs, k=5, least=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat those of documents of smaller doc_id."""
    ready(spark, lean=True)
    return passages.without_passages(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix of sources takes it."""
    ready(spark, lean=True)
    return mixing.take_mix(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, ids_sha256, decoded_sha256) of each row; ids are little-endian unsigned 32 bits."""
    ready(spark, lean=True)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "source"))
    return bpe.decode(encoded, path).select(
        "doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", non_toxic),
    ("ngram_jaccard_join", near_unique),
    ("substring_dedup", without_repeats),
    ("source_mix", mixed),
    ("byte_bpe", tokenised),
]

#: A trained model and fuzzy passages are no matter of SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    folder = (spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="rillmart-")).rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = f"{folder}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
