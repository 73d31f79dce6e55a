"""Benchmark decontamination over a distributed positional inverted index.

The words of all documents are stored once as postings (``postings.build_index``). Each
item gives its windows of ``size`` words, or one shorter window. A window is looked up
in each shard: the places of its rarest word are taken, moved back by that word's offset,
and intersected with the moved lists of the other words, from rare to common. What is
left are the exact phrases. A proximity match is a place of the window's rarest word with
all its other words within ``near`` words of it, in any order.

Items meet shards in blocks of about ``BLOCK_WORDS`` words. Equal items are looked up
once. Counts of words are over all documents.

Defined cases: null and empty texts have no words and no windows; an item without an id
takes no part; several rows of one item id are one item; repeated documents are searched
each by itself; an empty index or item table gives no matches; the longest text is held
by one task, as one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.llm.postings import build_index, indexed_rows, row_starts, split_words
from skillgauge.operators.joins import lookup_join

SIZE = 10
NEAR = 20
BLOCK_WORDS = 100_000
CANDIDATES = 2**20

PHRASE, NEARBY = 0, 1
_MATCHES = pa.schema([
    ("shard", pa.int64()), ("row", pa.int64()), ("class", pa.string()),
    ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
])
MATCH_SCHEMA = "shard long, row long, class string, kind int, start long, end long"


def with_words(items: DataFrame, text_name: str) -> DataFrame:
    """``items`` with the array ``words`` of a text column."""
    others = [c for c in items.columns if c != text_name]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = split_words(batch.column(batch.num_columns - 1))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*others, "words"])

    kept = items.select(*others, text_name)
    types = ", ".join(f"`{c}` {kind}" for c, kind in kept.dtypes[:-1])
    return kept.mapInArrow(words, f"{types}, words array<string>")


def item_classes(items: DataFrame) -> DataFrame:
    """``class``, ``item_id`` and ``words`` of the items that have words."""
    known = items.where("item_id is not null and size(words) > 0")
    return known.withColumn("class", F.sha2(F.array_join("words", " "), 256))


class ShardTerms:
    """Places of the searched words in one shard, as one sorted list of (word, place)."""

    def __init__(self, terms: list[str], places: list[bytes]):
        self.code = {term: no for no, term in enumerate(terms)}
        lists = [np.frombuffer(x, np.int32).astype(np.int64) for x in places]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.keys = np.concatenate([(no << 32) + x for no, x in enumerate(lists)] or [np.zeros(0, np.int64)])

    def lists(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the codes, place) for all places of these words."""
        sizes = self.sizes[codes]
        which = np.repeat(np.arange(len(codes)), sizes)
        at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return which, self.keys[self.starts[codes][which] + at] & 0xFFFFFFFF

    def between(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Does the word stand at a place from ``low`` to ``high``?"""
        base = codes.astype(np.int64) << 32
        at = np.searchsorted(self.keys, base + np.maximum(low, 0))
        inside = at < len(self.keys)
        inside[inside] = self.keys[at[inside]] <= (base + high)[inside]
        return inside


def find_windows(terms: ShardTerms, codes: np.ndarray, rare: np.ndarray, near: int):
    """(window, start) of exact phrases and (window, place) of proximity matches.

    ``codes`` holds the words of each window, ``rare`` their offsets from rare to common.
    """
    size = codes.shape[1]
    sizes = terms.sizes[np.take_along_axis(codes, rare[:, :1], 1)[:, 0]]
    # Windows in turns with a bounded number of candidates each.
    turn = np.cumsum(sizes) // CANDIDATES
    for part in np.split(np.arange(len(codes)), np.flatnonzero(np.diff(turn)) + 1):
        if not len(part):
            continue
        lead = np.take_along_axis(codes[part], rare[part][:, :1], 1)[:, 0]
        which, place = terms.lists(lead)
        window = part[which]
        start, open_, centre = place - rare[window, 0], window, place
        around = window
        for at in range(1, size):
            offset = rare[open_, at]
            place = start + offset
            hit = terms.between(codes[open_, offset], place, place) & (place >= 0)
            open_, start = open_[hit], start[hit]
            if near:
                hit = terms.between(codes[around, rare[around, at]], centre - near, centre + near)
                around, centre = around[hit], centre[hit]
        yield PHRASE, open_, start
        if near:
            yield NEARBY, around, centre


def merged(group: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Spans (group, start, end) that the given runs cover."""
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], (start + size)[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return group[first], start[first], (np.maximum.reduceat(end, first) if len(first) else end)


def search_shard(postings: pa.Table, queries: pa.Table, size: int, near: int) -> pa.Table:
    """Matches of one block of items in one shard."""
    is_head = postings["term"].is_null()
    head = postings.filter(is_head).slice(0, 1).to_pylist()
    rows = postings.filter(pc.invert(is_head))
    if not head or not rows.num_rows or not queries.num_rows:
        return _MATCHES.empty_table()
    sizes = np.frombuffer(head[0]["sizes"], np.int32)
    starts = row_starts(sizes)
    terms = ShardTerms(rows["term"].to_pylist(), rows["places"].to_pylist())
    names = queries["class"].to_pylist()
    by_size: dict[int, list] = {}
    for no, (words, counts) in enumerate(zip(queries["words"].to_pylist(), queries["counts"].to_pylist(), strict=True)):
        codes = np.array([terms.code.get(w, -1) for w in words])
        width = min(size, len(codes))
        seen = np.lib.stride_tricks.sliding_window_view(codes, width)
        rare = np.argsort(np.lib.stride_tricks.sliding_window_view(np.array(counts), width), axis=1, kind="stable")
        whole = (seen >= 0).all(axis=1)
        if whole.any():
            by_size.setdefault(width, []).append((np.full(whole.sum(), no), seen[whole], rare[whole]))
    out = []
    for width, parts in by_size.items():
        owner, codes, rare = (np.concatenate(x) for x in zip(*parts, strict=True))
        for kind, window, place in find_windows(terms, codes, rare, near):
            out.append((np.full(len(window), kind), owner[window], place, np.full(len(window), width if kind == PHRASE else 1)))
    if not out:
        return _MATCHES.empty_table()
    kind, owner, place, length = (np.concatenate(x) for x in zip(*out, strict=True))
    group, start, end = merged(kind * len(names) + owner, place, length)
    row = np.searchsorted(starts, start, side="right") - 1
    shard = np.full(len(group), head[0]["shard"], np.int64)
    classes = pa.array(names).take(pa.array(group % len(names)))
    kinds = (group // len(names)).astype(np.int32)
    columns = [shard, row, classes, kinds, start - starts[row], end - starts[row]]
    return pa.Table.from_arrays([pa.array(c) for c in columns], schema=_MATCHES)


def find_matches(index: DataFrame, classes: DataFrame, size: int = SIZE, near: int = NEAR) -> DataFrame:
    """``shard``, ``row``, ``class``, ``kind``, ``start``, ``end``: words of a row that an
    item's windows cover (kind 0), or where one of them is nearby (kind 1)."""
    texts = classes.select("class", "words").dropDuplicates(["class"])
    totals = texts.agg(F.sum(F.size("words")).alias("n")).first()
    blocks = -(-(totals.n or 0) // BLOCK_WORDS) or 1
    texts = texts.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int"))
    uses = texts.select("block", F.explode("words").alias("term")).distinct()
    words = uses.select("term").distinct()
    counts = lookup_join(
        index.where("term is not null").select("term", "n", "shard"), words, ["term"], "left_semi", ["shard"]
    ).groupBy("term").agg(F.sum("n").alias("total"))
    ranked = lookup_join(
        texts.select("block", "class", F.posexplode("words").alias("at", "term")), counts, ["term"], "left", ["class"]
    )
    order = F.sort_array(F.collect_list(F.struct("at", "term", F.coalesce("total", F.lit(0)).alias("total"))))
    queries = ranked.groupBy("block", "class").agg(order.alias("all"))
    queries = queries.select("block", "class", F.col("all.term").alias("words"), F.col("all.total").alias("counts"))

    heads = index.where("term is null").select("shard", "sizes")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    heads = heads.select(all_blocks.alias("block"), "shard", F.lit(None).cast("string").alias("term"), F.lit(None).cast("binary").alias("places"), "sizes")
    lists = index.where("term is not null").select("shard", "term", "places")
    lists = lookup_join(lists, uses, ["term"], "inner", ["shard"])
    lists = lists.select("block", "shard", "term", "places", F.lit(None).cast("binary").alias("sizes"))
    postings = heads.unionByName(lists)
    asked = heads.select("block", "shard").join(queries, "block")
    asked = asked.toDF(*asked.columns)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_shard(left, right, size, near)

    keys = ["block", "shard"]
    return postings.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, MATCH_SCHEMA)


def contamination(docs: DataFrame, items: DataFrame, index_path: str, match_path: str, size: int = SIZE, near: int = NEAR) -> DataFrame:
    """One row per document (doc_id, text): how much of it the items (item_id, text) hold.

    ``n_words``, ``n_hit`` (words inside an exact phrase), ``n_items`` and ``items`` (ids
    sorted as strings, comma-joined) of exact phrases, ``n_near`` (items that are nearby
    without an exact phrase).
    """
    spark = docs.sparkSession
    index = build_index(docs, "doc_id", "text", index_path)
    classes = item_classes(with_words(items.select("item_id", "text"), "text"))
    find_matches(index, classes, size, near).write.parquet(match_path)
    matches = spark.read.parquet(match_path)
    keys = ["shard", "row"]
    before = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    phrases = matches.where(F.col("kind") == PHRASE)
    covered = F.coalesce(F.max("end").over(before), F.lit(0))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), covered))
    n_hit = phrases.select(*keys, added.alias("added")).groupBy(*keys).agg(F.sum("added").alias("n_hit"))
    kinds = matches.groupBy(*keys, "class").agg(F.min("kind").alias("kind"))
    members = classes.select("class", F.col("item_id").cast("string").alias("item")).distinct()
    per_item = lookup_join(kinds, members, ["class"], "inner", keys)
    per_item = per_item.groupBy(*keys, "item").agg(F.min("kind").alias("kind"))
    exact = F.when(F.col("kind") == PHRASE, F.col("item"))
    found = per_item.groupBy(*keys).agg(
        F.count(exact).alias("n_items"),
        F.array_join(F.sort_array(F.collect_list(exact)), ",").alias("items"),
        F.count_if(F.col("kind") == NEARBY).alias("n_near"),
    )
    rows = indexed_rows(index).join(n_hit, keys, "left").join(found, keys, "left")

    def number(name):
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    return rows.select(
        F.col("id").alias("doc_id"), "n_words", number("n_hit"), number("n_items"),
        F.coalesce("items", F.lit("")).alias("items"), number("n_near"),
    )
