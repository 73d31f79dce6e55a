"""Prefix trie of conversations, with count-min screening of prefix digests.

Each conversation is a sequence of turns. The digest of its first d turns is the
exclusive or of one 128-bit hash for each (place, turn), made from the turn's SHA-256.
A count-min sketch over all prefix digests never estimates too little: an estimate of
one proves that a prefix occurs in one conversation alone. Such a prefix, and the whole
tail after it, is a node of its own and is put out where it is. Only prefixes that may
be shared are shuffled, grouped by their exact digest and joined with their parents.

Sums over subtrees need no walk up the tree. Each node is credited to its smallest
member; a member adds to a node what it was credited from there on down, which is a
suffix sum along the conversation, so one grouping gives every node its sum.

Scale: turns are dealt by range of (conversation, turn), so one long conversation
spreads over many tasks; running values are made within a run of rows and carried on by
the few sums of earlier runs. Texts are replaced by digests before any shuffle. The
sketch has at most ``MAX_WIDTH`` counters of two bits a row (16 MB in all); when it is
full, more prefixes are shuffled and the result is the same.

Defined cases: turns are ordered by turn (null first), then role, then SHA-256 of the
text; null role or text is empty; repeated rows are repeated turns; rows without a
conversation id are in no conversation; an empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_WIDTH, MAX_WIDTH = 2**12, 2**25
#: Counters for each prefix, while the sketch may grow.
ROOM = 8
BLOCK = 2**16
#: Rows of a conversation that one window sorts at most.
RUN = 4096

NODE = ["depth", "x1", "x2"]


def narrow_turns(talks: DataFrame) -> DataFrame:
    """Turns with the digest and the number of words of their text, without the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = talks.where("conv_id is not null")
    return rows.select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"),
        F.unhex(digest).alias("digest"), words.cast("long").alias("words"),
    )


def dealt(turns: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Turns sorted by conversation over all tasks, stored at ``path``, and their runs.

    A run is the part of a conversation in one task: its number of turns ``n``, the
    place ``first`` of its first row, and how many turns are ``before`` it.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    rows = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id grows along each task's sorted rows.
    rows = rows.withColumns({"at": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    rows.select("conv_id", "digest", "words", "at", "part").write.parquet(path)
    rows = turns.sparkSession.read.parquet(path)
    runs = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def running(rows: DataFrame, key: str, order: str, makes: dict[str, tuple[Callable, Column, Column]], down: bool = False) -> DataFrame:
    """``rows`` with running aggregates along ``order`` (from the end, if ``down``).

    ``makes`` maps a new column to (aggregate, input, neutral value, combination) parts.
    A key's rows are cut into runs of ``RUN`` places, so that no window sorts more; what
    the other runs give is added from one row for each run.
    """
    cut = rows.withColumn("__run", F.floor(F.col(order) / RUN).cast("long"))
    sums = cut.groupBy(key, "__run").agg(*[make(value).alias(f"__{name}") for name, (make, value, _) in makes.items()])
    by_run = F.desc("__run") if down else F.asc("__run")
    before = Window.partitionBy(key).orderBy(by_run).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        key, "__run", *[F.coalesce(make(f"__{name}").over(before), F.lit(0).cast("long")).alias(f"__{name}") for name, (make, _, _) in makes.items()]
    )
    by_order = F.desc(order) if down else F.asc(order)
    here = Window.partitionBy(key, "__run").orderBy(by_order).rowsBetween(Window.unboundedPreceding, 0)
    within = cut.withColumns({name: make(value).over(here) for name, (make, value, _) in makes.items()})
    joined = within.join(sums, [key, "__run"])
    ended = joined.withColumns({name: join(F.col(name), F.col(f"__{name}")) for name, (_, _, join) in makes.items()})
    return ended.drop("__run", *[f"__{name}" for name in makes])


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def with_prefix_digests(turns: DataFrame) -> DataFrame:
    """Rebuilt turns (conv_id, depth, digest, words, ends) with the digests of the prefix they
    end and of the one before: ``x1``, ``x2``, ``p1``, ``p2``."""
    hashed = turns.withColumns({"e1": F.xxhash64("depth", "digest"), "e2": F.xxhash64("digest", F.lit("e2"), "depth")})
    made = running(
        hashed, "conv_id", "depth",
        {"x1": (F.bit_xor, F.col("e1"), _xor), "x2": (F.bit_xor, F.col("e2"), _xor)},
    )
    return made.select(
        "conv_id", "depth", "x1", "x2", _xor(F.col("x1"), F.col("e1")).alias("p1"),
        _xor(F.col("x2"), F.col("e2")).alias("p2"), "words", "ends",
    )


# --- count-min sketch ---------------------------------------------------------


def _slots(x1: np.ndarray, x2: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return x1 & (width - 1), x2 & (width - 1)


def _count(counters: np.ndarray, slots: np.ndarray) -> None:
    slots, times = np.unique(slots, return_counts=True)
    counters[slots] = np.minimum(counters[slots] + np.minimum(times, 2), 2)


def _packed(block: np.ndarray) -> bytes:
    """Counters 0, 1, 2 as two bitmaps: at least one, at least two."""
    return np.packbits(block >= 1).tobytes() + np.packbits(block >= 2).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    half = len(bits) // 2
    return bits[:half] + bits[half:]


_CELLS = pa.schema([("block", pa.int64()), ("cells", pa.binary())])


def sketch(prefixes: DataFrame) -> tuple[int, np.ndarray]:
    """(width, two rows of counters up to 2) over (x1, x2) of all prefixes.

    Every task counts its own rows; blocks of counters are added up by block. The
    result is bounded by ``MAX_WIDTH``, so it may go to the driver and to all tasks.
    """
    n = prefixes.count()
    width = min(max(1 << (ROOM * n).bit_length(), LEAST_WIDTH), MAX_WIDTH)
    size = min(BLOCK, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(2 * width, np.uint8)
        for batch in batches:
            low, high = _slots(*(c.to_numpy() for c in batch.columns), width)
            _count(counters, low)
            _count(counters, high + width)
        blocks = counters.reshape(-1, size)
        used = np.flatnonzero(blocks.any(axis=1))
        for first in range(0, len(used), 64):
            some = used[first : first + 64]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([_packed(blocks[b]) for b in some], pa.binary())], schema=_CELLS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = _unpacked(cells)
                held[block] = np.minimum(held[block] + own, 2) if block in held else own
        for block, cells in held.items():
            yield pa.RecordBatch.from_pylist([{"block": block, "cells": _packed(cells)}], _CELLS)

    parts = prefixes.select("x1", "x2").mapInArrow(count, "block long, cells binary")
    sums = parts.repartition("block").mapInArrow(add, "block long, cells binary")
    out = np.zeros((2 * width // size, size), np.uint8)
    for row in sums.toLocalIterator():
        out[row.block] = _unpacked(bytes(row.cells))
    return width, out.reshape(2, width)


def screened(prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``shared`` and ``parent_shared``: may the prefix, or the one
    before, occur twice? False is certain. The empty prefix counts as shared."""
    width, counters = sketch(prefixes)
    sent = prefixes.sparkSession.sparkContext.broadcast(np.packbits(counters >= 2, axis=1))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = sent.value

        def often(x1, x2):
            hit = [(row[at >> 3] >> (7 - (at & 7))) & 1 for row, at in zip(twice, _slots(x1, x2, width), strict=True)]
            return (hit[0] & hit[1]).astype(bool)

        for batch in batches:
            depth, *x = (batch.column(c).to_numpy() for c in ("depth", "x1", "x2", "p1", "p2"))
            flags = [often(*x[:2]), often(*x[2:]) | (depth == 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, flags)], [*batch.schema.names, "shared", "parent_shared"])

    types = ", ".join(f"{c} {kind}" for c, kind in prefixes.dtypes)
    return prefixes.mapInArrow(flag, f"{types}, shared boolean, parent_shared boolean")


# --- nodes ----------------------------------------------------------------------


def end_lists(ends: DataFrame) -> DataFrame:
    """Digest of the sorted conversation ids that end at each node, read as a stream, so
    that no list of ids is held."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row():
            return pa.RecordBatch.from_pylist([dict(zip(NODE, key, strict=True)) | {"ends": state.hexdigest()}])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in [*NODE, "conv_id"]]
            for *node, conv in zip(*columns, strict=True):
                if node != key:
                    if key:
                        yield row()
                    key, state = node, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
        if key:
            yield row()

    dealt = ends.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return dealt.mapInArrow(digest, "depth long, x1 long, x2 long, ends string")


def trie_nodes(turns: DataFrame, lengths: DataFrame, fresh: Callable[[], str]) -> DataFrame:
    """All nodes of the trie.

    ``turns`` holds conv_id, depth (from 1), digest, words and whether the turn is the
    last (``ends``); ``lengths`` every conversation once with its number of turns,
    ``length``.
    """
    spark = turns.sparkSession
    path = fresh()
    with_prefix_digests(turns).write.parquet(path)
    flagged = screened(spark.read.parquet(path))
    path = fresh()
    flagged.write.parquet(path)
    prefixes = spark.read.parquet(path)

    # The root is a prefix of every conversation.
    zero = F.lit(0).cast("long")
    root = lengths.select(
        "conv_id", *[zero.alias(c) for c in ("depth", "x1", "x2", "p1", "p2", "words")],
        (F.col("length") == 0).alias("ends"),
    )
    columns = root.columns
    shared = prefixes.where("shared").select(*columns).unionByName(root)
    alone = prefixes.where("not shared")

    path = fresh()
    shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    ).write.parquet(path)
    nodes = spark.read.parquet(path)

    # Children: shared ones, and those that are alone below a node that may be shared.
    up = (F.col("depth") - 1).alias("depth")
    below = nodes.where("depth > 0").select(up, "p1", "p2").unionByName(
        alone.where("parent_shared").select(up, "p1", "p2")
    ).withColumnsRenamed({"p1": "x1", "p2": "x2"})
    children = below.groupBy(*NODE).agg(F.count("*").alias("n_children"))
    path = fresh()
    nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).write.parquet(path)
    nodes = spark.read.parquet(path)

    # What each conversation is credited with: saved tokens of the nodes it is the
    # smallest member of, and one leaf if its end is a childless node of which it is
    # the smallest member, or a node of its own.
    credit = nodes.select(
        F.col("node").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    )
    path_rows = shared.select("conv_id", *NODE).join(credit, ["conv_id", "depth"], "left").unionByName(
        alone.where("ends").select("conv_id", *NODE, zero.alias("saved"), F.lit(1).cast("long").alias("leaf"))
        .withColumns({"x1": F.lit(None).cast("long"), "x2": F.lit(None).cast("long")})
    )
    path_rows = path_rows.withColumns({c: F.coalesce(c, zero) for c in ("saved", "leaf")})
    summed = running(
        path_rows, "conv_id", "depth",
        {"all_saved": (F.sum, F.col("saved"), _plus), "all_leaves": (F.sum, F.col("leaf"), _plus)},
        down=True,
    )
    sums = summed.where("x1 is not null").groupBy(*NODE).agg(
        F.sum("all_saved").alias("saved_tokens"), F.sum("all_leaves").alias("n_leaves")
    )
    ends = end_lists(shared.where("ends"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    grouped = nodes.join(sums, NODE).join(ends, NODE, "left")
    parents = nodes.select(F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"))
    over = ["depth", "p1", "p2"]
    # A shared-looking node below one that is alone has that conversation as parent.
    grouped = grouped.join(parents, over, "left").select(
        F.col("node").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "node")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", none).alias("ends_sha256"),
    )
    one = F.lit(1).cast("long")

    def own_nodes(rows: DataFrame, parent: Column) -> DataFrame:
        return rows.select(
            "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"),
            (~F.col("ends")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
            F.when(F.col("ends"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none).alias("ends_sha256"),
        )

    tails = own_nodes(alone.where("not parent_shared"), F.col("conv_id"))
    heads = own_nodes(alone.where("parent_shared").join(parents, over, "left"), F.coalesce("parent", "conv_id"))
    return grouped.unionByName(tails).unionByName(heads)


def rebuilt(talks: DataFrame, fresh: Callable[[], str], group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of conversations that share beginnings.

    Conversation c has the first h turns of conversation c - c % ``group``, then its own
    after its first h; h is the CRC-32 of c in decimal, modulo ``heads``.
    """
    rows, runs = dealt(narrow_turns(talks), fresh())
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    convs = runs.groupBy("conv_id").agg(F.sum("n").alias("own")).withColumns(
        {"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}
    )
    sizes = convs.where(F.col("conv_id") == F.col("base")).select("base", F.col("own").alias("base_size"))
    taken = F.least(F.col("h"), F.coalesce("base_size", F.lit(0)))
    path = fresh()
    convs.join(sizes, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
    ).write.parquet(path)
    lengths = talks.sparkSession.read.parquet(path)
    # Facts about a conversation reach its turns through its runs, of which a very long
    # conversation has many, each in a task of its own.
    placed = rows.join(runs.join(lengths, "conv_id").drop("n"), ["conv_id", "part"]).withColumn(
        "pos", F.col("at") - F.col("first") + F.col("before") + 1
    )
    is_last = (F.col("depth") == F.col("length")).alias("ends")
    own = placed.where(F.col("pos") > F.col("h")).withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    own = own.select("conv_id", "depth", "digest", "words", is_last)
    begins = placed.where((F.col("pos") < heads) & (F.col("conv_id") == F.col("base"))).select(
        "base", F.col("pos").alias("depth"), "digest", "words"
    )
    first = lengths.where("taken > 0").join(begins, "base").where("depth <= taken")
    first = first.select("conv_id", "depth", "digest", "words", is_last)
    return first.unionByName(own), lengths.select("conv_id", "length")
