"""The queries of this package over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.llm import bitslice, jaccard, merkle, mixing, notices, phrases, pieces, private, ranked, ranking, repeats, trie, warc
from skillgauge.session import fresh_path

WARC_DATE = "2026-01-01T00:00:00Z"


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    index = bitslice.build_index(vectors, fresh_path(spark, "slices"))
    return bitslice.top_k(index, vectors.where("vec_id % 50 = 0"), 5)


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ranker = ranking.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = F.col("__score")
    return ranking.scored(docs, ranker).select(
        "doc_id",
        ranking.held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= ranking.ACCEPT, 1).otherwise(0).alias("predicted"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    asked = ("n_tokens", "ids_sha256", "decoded_sha256")
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), outputs=asked)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    rows = notices.scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    listed = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first_word"], s["end_word"], s["errors"]))
    return rows.withColumn("spans", F.array_join(listed, ","))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share most of their shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard.linked_components(docs, lambda: fresh_path(spark, "near"))


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = private.propose(docs).drop("text")
    rows = private.labelled_rows(found, fresh_path(spark, "spans"))
    spans = F.col("__spans")
    base = F.filter(spans, lambda s: s["base"])
    counts = [
        private.counted(base, no).alias(f"n_{kind}")
        for no, (kind, _) in enumerate(private.BASE)
    ]
    digest = F.sha2(private.listed(base).cast("binary"), 256)
    return rows.select("doc_id", *counts, digest.alias("base_sha256"), private.listed(spans).alias("spans"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the word windows that occur earlier."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = repeats.remove_repeats(docs, lambda: fresh_path(spark, "repeats"))
    digest = F.sha2(F.col("kept").cast("binary"), 256)
    return rows.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return merkle.fingerprints(docs, fresh_path(spark, "fingerprints"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes from each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixing.mix(docs, mixing.MixRule(), fresh_path(spark, "sizes"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    marked = warc.mark_revisits(pages, "page_id", "html", 100, fresh_path(spark, "firsts"))
    path = fresh_path(spark, "warc")
    warc.write_archives(
        marked, path, warc.train_dictionary(pages, "html"), WARC_DATE, ("page_id", "url", "refers_to", "html")
    )
    rows = warc.read_archives(spark, path)
    return rows.select(
        warc.checked(F.col("record_id").cast("long"), F.col("error")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")

    def fresh():
        return fresh_path(spark, "trie")

    turns, lengths = trie.rebuilt(talks, fresh)
    return trie.trie_nodes(turns, lengths, fresh)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked.ranked_search(docs, items, fresh_path(spark, "postings"), fresh_path(spark, "owned"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document holds of the benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = phrases.contamination(docs, items, fresh_path(spark, "postings"), fresh_path(spark, "matches"))
    digest = F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest, (F.col("n_hit") > 0).alias("contaminated"), "n_near"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_quality_ranking": op2_quality_ranking,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_license_scan": op4_license_scan,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_private_data": op6_private_data,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_merkle": op8_merkle,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_decontamination": op13_decontamination,
}
