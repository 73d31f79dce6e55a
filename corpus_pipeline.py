"""The corpus pipeline: five stages over documents, each written before the next reads it.

Every stage but the last returns the columns of documents. Null or empty texts are
scored, linked, scanned, mixed and encoded as empty texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.llm import jaccard, mixing, pieces, private, ranking
from skillgauge.session import fresh_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts."""
    ranker = ranking.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ranking.scored(docs, ranker).where(F.col("__score") >= ranking.ACCEPT).select(*docs.columns)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    found = jaccard.linked_components(docs, lambda: fresh_path(spark, "near"))
    # Rows without an id, and those without words, are in no group.
    others = found.where("component_id <> doc_id").select(F.col("doc_id").alias("__other")).distinct()
    return docs.join(others, F.col("doc_id") == F.col("__other"), "left_anti")


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the name of its kind."""
    rows = private.labelled_rows(private.propose(docs), fresh_path(spark, "spans"))
    text = private.redacted(F.col("text"), F.col("__spans"))
    rows = rows.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; whole passes repeat documents."""
    return mixing.apply_mix(docs, mixing.MixRule(), fresh_path(spark, "sizes"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each text of the mix."""
    asked = ("n_tokens", "ids_sha256", "decoded_sha256")
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), outputs=asked)


STAGES = [
    ("quality_ranking", keep_good),
    ("ngram_jaccard", keep_first),
    ("private_data", hide_private),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]
#: SQL cannot train a ranking or merge pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
