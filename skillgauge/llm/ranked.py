"""Ranked lexical search by pipelined term partitioning.

Terms are owned by ``OWNERS`` stages, rare terms first. Items travel in bundles. For each
shard of the index a bundle carries the scores it has gathered so far, and passes the
stages one after the other: a cogroup brings it together with the postings of the
stage's terms in that shard, whose integer contributions are added. After a stage, only
documents stay in the bundle whose score, with the most that later stages can add,
reaches the shard's k-th best score; a document that a later stage would have to bring in
is brought in only while what is left can still reach it. Both leave results exact.
At the end the k best of each shard meet in one ranking.

The score is that of Okapi BM25 in integers, see ``term_weight`` and ``contribution``.

Defined cases: null and empty texts have no terms, match nothing and do not count as
documents; an item without terms has no results; equal item rows count once, items of
one id with different texts are ranked apart; repeated documents are ranked each by
itself, equal scores by document id; an empty table gives an empty result. Scores are
added as 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.llm.phrases import with_words
from skillgauge.llm.postings import build_index, row_starts
from skillgauge.operators.joins import lookup_join

OWNERS = 4
BUNDLE_WORDS = 8_000
#: No contribution is larger than this times the weight of its term.
UNIT = 1_000_000

BUNDLE_SCHEMA = "bundle int, shard long, items array<string>, rest binary, sizes binary, which binary, docs binary, scores binary"
_BUNDLE = pa.schema([
    ("bundle", pa.int32()), ("shard", pa.int64()), ("items", pa.list_(pa.string())), ("rest", pa.binary()),
    ("sizes", pa.binary()), ("which", pa.binary()), ("docs", pa.binary()), ("scores", pa.binary()),
])


def contribution(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score for each unit of its weight."""
    tf, n = tf.astype(np.int64), n.astype(np.int64)
    m = 100 - 75 + (75 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_frequencies(places: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, occurrences) of one list of places."""
    row = np.searchsorted(starts, np.frombuffer(places, np.int32), side="right") - 1
    first = np.flatnonzero(np.diff(row, prepend=-1))
    return row[first], np.diff(np.append(first, len(row)))


def best_scores(scores: np.ndarray, k: int) -> int:
    """The k-th largest score, or 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def pass_stage(carried: dict, lists: list[dict], stage: int, k: int, n_docs: int, n_terms: int) -> dict:
    """A bundle after the stage with these postings."""
    sizes = np.frombuffer(carried["sizes"], np.int32)
    starts = row_starts(sizes)
    n_items = len(carried["items"])
    rest = np.frombuffer(carried["rest"], np.int64).reshape(n_items, -1)
    which = np.frombuffer(carried["which"], np.int32)
    docs, scores = np.frombuffer(carried["docs"], np.int32), np.frombuffer(carried["scores"], np.int64)
    bounds = np.searchsorted(which, np.arange(n_items + 1))
    added: list[list] = [[] for _ in range(n_items)]
    for entry in lists:
        row, tf = term_frequencies(entry["places"], starts)
        unit = contribution(tf, sizes[row], n_docs, n_terms)
        for item, weight in zip(entry["users"], entry["weights"], strict=True):
            added[item].append((row, unit * weight))
    out_which, out_docs, out_scores = [], [], []
    line = np.zeros(len(sizes), np.int64)
    for item in range(n_items):
        mine = slice(bounds[item], bounds[item + 1])
        old, total = docs[mine], scores[mine]
        line[old] = total
        touched = [old]
        # A document not seen so far can only gain what this and later stages give.
        entering = rest[item, stage] >= best_scores(total, k)
        for row, gain in added[item]:
            if not entering:
                keep = line[row] > 0
                row, gain = row[keep], gain[keep]
            line[row] += gain
            touched.append(row)
        seen = np.unique(np.concatenate(touched))
        total = line[seen]
        line[seen] = 0
        keep = (total > 0) & (total + rest[item, stage + 1] >= best_scores(total, k))
        out_which.append(np.full(keep.sum(), item, np.int32))
        out_docs.append(seen[keep].astype(np.int32))
        out_scores.append(total[keep])
    return carried | {
        "which": np.concatenate(out_which).tobytes() if out_which else b"",
        "docs": np.concatenate(out_docs).tobytes() if out_docs else b"",
        "scores": np.concatenate(out_scores).tobytes() if out_scores else b"",
    }


def shard_best(carried: dict, ids: list, k: int) -> Iterator[tuple]:
    """(item, row, id, score) of the k best documents of each item in a shard."""
    which = np.frombuffer(carried["which"], np.int32)
    docs, scores = np.frombuffer(carried["docs"], np.int32), np.frombuffer(carried["scores"], np.int64)
    bounds = np.searchsorted(which, np.arange(len(carried["items"]) + 1))
    for no, item in enumerate(carried["items"]):
        mine = slice(bounds[no], bounds[no + 1])
        least = best_scores(scores[mine], k)
        found = [(-int(s), ids[d], int(d)) for d, s in zip(docs[mine], scores[mine], strict=True) if s >= least]
        found.sort(key=lambda x: (x[0], x[1] is None, x[1] or 0, x[2]))
        for score, doc_id, row in found[:k]:
            yield item, row, doc_id, -score


def search(index: DataFrame, items: DataFrame, k: int, path: str, owners: int = OWNERS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of each item's k best documents.

    ``items`` holds item_id and the array ``words``. The postings of their terms are
    stored by owner at ``path``.
    """
    spark = index.sparkSession
    heads = index.where("term is null").select("shard", "n", "df", "ids", "sizes")
    whole = heads.agg(F.sum("n").alias("terms"), F.sum("df").alias("docs")).first()
    n_terms, n_docs = whole.terms or 0, whole.docs or 0
    name = F.to_json(F.struct("item_id", "words"))
    named = items.where("size(words) > 0").withColumn("item", F.sha2(name, 256)).dropDuplicates(["item"])
    totals = named.agg(F.sum(F.size("words")).alias("n")).first()
    bundles = -(-(totals.n or 0) // BUNDLE_WORDS) or 1
    named = named.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    uses = named.select("bundle", "item", F.explode("words").alias("term"))
    uses = uses.groupBy("bundle", "item", "term").agg(F.count("*").alias("times"))
    terms = uses.select("term").distinct()
    lists = index.where("term is not null").select("shard", "term", "df", "places")
    counts = lookup_join(lists.select("shard", "term", "df"), terms, ["term"], "left_semi", ["shard"])
    counts = counts.groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weighed = counts.withColumn("weight", F.floor(F.log(ratio) * 1000).cast("long"))
    # Owners by document frequency, each with about a factor less of documents.
    share = F.log(F.lit(float(n_docs + 1)) / F.col("df")) / F.log(F.lit(float(n_docs + 2)))
    owner = F.least(F.lit(owners - 1), F.greatest(F.lit(0), F.floor((1 - share) * owners))).cast("int")
    weighed = weighed.withColumn("stage", owner)
    uses = lookup_join(uses, weighed, ["term"], "inner", ["item"]).withColumn("gain", F.col("weight") * F.col("times"))

    # What stages from s on can still add to an item: rest[s], with rest[owners] = 0.
    left = [F.coalesce(F.sum(F.when(F.col("stage") >= s, F.col("gain") * UNIT)), F.lit(0)).cast("long") for s in range(owners + 1)]
    members = uses.groupBy("bundle", "item").agg(F.array(*left).alias("rest"))
    members = members.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("item", "rest"))).alias("all"))
    members = members.select("bundle", F.col("all.item").alias("items"), F.flatten("all.rest").alias("rest"))
    place = members.select("bundle", F.posexplode("items").alias("user", "item"))
    users = uses.join(place, ["bundle", "item"]).groupBy("bundle", "stage", "term").agg(
        F.collect_list(F.struct("user", "gain")).alias("users")
    )
    asked = lookup_join(lists, users, ["term"], "inner", ["shard"]).select(
        "bundle", "shard", "stage", "places", F.col("users.user").alias("users"), F.col("users.gain").alias("weights")
    )
    asked.write.partitionBy("stage").parquet(path)
    asked = spark.read.schema(asked.schema).parquet(path)

    all_bundles = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))
    carried = heads.select(all_bundles.alias("bundle"), "shard", "sizes").join(members, "bundle")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                r | {"rest": np.array(r["rest"], np.int64).tobytes(), "which": b"", "docs": b"", "scores": b""}
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(rows, _BUNDLE)

    def stage_function(stage: int):
        def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
            rows = [pass_stage(r, postings.to_pylist(), stage, k, n_docs, n_terms) for r in bundle.to_pylist()]
            return pa.Table.from_pylist(rows, _BUNDLE)

        return run

    keys = ["bundle", "shard"]
    carried = carried.mapInArrow(start, BUNDLE_SCHEMA)
    for stage in range(owners):
        owned = asked.where(F.col("stage") == stage).groupBy(*keys)
        carried = carried.groupBy(*keys).cogroup(owned).applyInArrow(stage_function(stage), BUNDLE_SCHEMA)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = [int(x) if x else None for x in row["ids"].decode().split(",")]
                found = list(shard_best(row, ids, k))
                columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
                arrays = [pa.array(columns[0], pa.string()), pa.array([row["shard"]] * len(found), pa.int64())]
                arrays += [pa.array(c, pa.int64()) for c in columns[1:]]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "shard", "row", "doc_id", "score"])

    ended = carried.select("shard", "items", "which", "docs", "scores").join(heads.select("shard", "ids"), "shard")
    best = ended.mapInArrow(select, "item string, shard long, row long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return lookup_join(ranked, named.select("item", "item_id"), ["item"], "inner", ["doc_id"]).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def ranked_search(docs: DataFrame, items: DataFrame, index_path: str, owned_path: str, k: int = 10) -> DataFrame:
    """Each item (item_id, text) ranked against all documents (doc_id, text)."""
    index = build_index(docs, "doc_id", "text", index_path)
    return search(index, with_words(items.select("item_id", "text"), "text"), k, owned_path)
