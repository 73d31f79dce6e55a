"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers and packed into blocks. A block keeps, for each
dimension and bit, one bitmap over its rows. A query's score is a weighted sum of
dimensions, so its slices come from adding attribute slices with bitmap arithmetic,
64 rows a word and many queries at once. The k-th largest sum is found from the most
significant slice down. The low ``dropped`` bits of an attribute are left out of the
slices; rows that could still reach the k-th score are resolved exactly.

Rows meet queries in blocks: each chunk of queries is sent to each group of blocks.

Vectors with a component of 2**24 or more after scaling are kept in blocks of their own,
which hold eight-byte values and have as many slices as those values need.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no
part; a component of 2**62 or more after scaling, or a returned score that does not fit a
long, raises an error; vectors of different lengths are not compared; a row never meets
queries of its own id; equal query rows count once, equal candidate rows each; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
NARROW = 2**24
LIMIT = 2**62
BLOCK_ROWS = 4096
CHUNK_QUERIES = 256
TILE_QUERIES = 64
DROPPED = 2

BLOCK_SCHEMA = "dim int, part int, no int, width int, ids binary, values binary, slices binary"
CHUNK_SCHEMA = "dim int, ids binary, values binary"


def quantised(batch: pa.RecordBatch, scale: int) -> Iterator[tuple]:
    """((dimension, bytes a value), ids, integer matrix) of a batch's valid vectors."""
    ids, vectors = batch.column(0), batch.column(1)
    keep = np.flatnonzero(vectors.is_valid().to_numpy(False) & ids.is_valid().to_numpy(False))
    vectors, ids = vectors.take(pa.array(keep)), ids.take(pa.array(keep)).to_numpy().astype(np.int64)
    sizes = vectors.value_lengths().to_numpy(False)
    flat = vectors.flatten().to_numpy(False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        given = flat[starts[rows][:, None] + np.arange(dim)]
        finite = np.isfinite(given).all(axis=1)
        rows, matrix = rows[finite], np.floor(given[finite] * scale)
        largest = np.abs(matrix).max(axis=1, initial=0)
        if (largest >= LIMIT).any():
            raise OverflowError("a vector component is too large for a score that is a long")
        for width, good in ((4, largest < NARROW), (8, largest >= NARROW)):
            if good.any():
                yield (int(dim), width), ids[rows[good]], matrix[good].astype(np.int64)


def gathered(batches, scale, size):
    """Blocks of at most ``size`` vectors of one dimension and width."""
    kept: dict[tuple, list] = {}
    for batch in batches:
        for kind, ids, matrix in quantised(batch, scale):
            kept.setdefault(kind, []).append((ids, matrix))
            while sum(len(i) for i, _ in kept[kind]) >= size:
                ids, matrix = (np.concatenate(x) for x in zip(*kept[kind], strict=True))
                yield *kind, ids[:size], matrix[:size]
                kept[kind] = [(ids[size:], matrix[size:])]
    for kind, parts in kept.items():
        ids, matrix = (np.concatenate(x) for x in zip(*parts, strict=True))
        if len(ids):
            yield *kind, ids, matrix


def slice_block(matrix: np.ndarray, dropped: int) -> np.ndarray:
    """Bitmaps [dimension, bit, word] of the values above each dimension's lowest."""
    n, dim = matrix.shape
    over = (matrix - matrix.min(axis=0)) >> dropped
    bits = int(over.max(initial=0)).bit_length()
    words = -(-n // 64)
    out = np.zeros((dim, bits, words * 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits((over.T >> bit & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, bit, : packed.shape[1]] = packed
    return out.view(np.uint64)


def add_into(total: list, part: list, carry: np.ndarray, spare: np.ndarray):
    """total += part, both lists of slices from the least significant up.

    Buffers change places with slices, so the two left over are handed back; the
    slices of ``part`` are used up.
    """
    carry.fill(0)
    for at, x in enumerate(part):
        if at == len(total):
            total.append(np.zeros_like(carry))
        a = total[at]
        np.bitwise_xor(a, x, out=spare)
        np.bitwise_and(a, x, out=a)
        np.bitwise_and(spare, carry, out=x)
        np.bitwise_xor(spare, carry, out=spare)
        np.bitwise_or(a, x, out=carry)
        total[at], spare = spare, a
    at = len(part)
    while carry.any():
        if at == len(total):
            total.append(np.zeros_like(carry))
        np.bitwise_and(total[at], carry, out=spare)
        np.bitwise_xor(total[at], carry, out=total[at])
        carry, spare = spare, carry
        at += 1
    return carry, spare


def sum_slices(slices: np.ndarray, weights: np.ndarray) -> tuple[list, np.ndarray]:
    """Slices [query, word] of sum(|w| * u), u the value over the low, or under the high.

    Each bit of the weights is a round: the sum so far doubles (its slices move up
    by one) and the dimensions whose weight has that bit are added.
    """
    dim, bits, words = slices.shape
    shape = (len(weights), words)
    sizes, ones = np.abs(weights), np.uint64(0xFFFFFFFFFFFFFFFF)
    flip = np.where(weights < 0, ones, np.uint64(0))
    carry, spare = np.empty(shape, np.uint64), np.empty(shape, np.uint64)
    part = [np.empty(shape, np.uint64) for _ in range(bits)]
    total: list = []
    for bit in range(int(sizes.max(initial=0)).bit_length() - 1, -1, -1):
        round_sum: list = []
        chosen = (sizes >> bit & 1).astype(bool)
        for d in np.flatnonzero(chosen.any(axis=0)):
            mask = np.where(chosen[:, d], ones, np.uint64(0))[:, None]
            turn = flip[:, d][:, None]
            for b in range(bits):
                np.bitwise_xor(slices[d, b][None, :], turn, out=part[b])
                np.bitwise_and(part[b], mask, out=part[b])
            carry, spare = add_into(round_sum, part, carry, spare)
        if total:
            total.insert(0, np.zeros(shape, np.uint64))
        if round_sum:
            carry, spare = add_into(total, round_sum, carry, spare)
    return total, sizes


def at_least(total: list, valid: np.ndarray, k: int, slack: np.ndarray) -> np.ndarray:
    """Rows whose sum is at least the k-th largest less ``slack``, by query."""
    over, equal = np.zeros_like(valid), valid.copy()
    level = np.zeros(len(valid), object)
    for at in range(len(total) - 1, -1, -1):
        hit = equal & total[at]
        found = over | hit
        enough = np.bitwise_count(found).sum(axis=1) >= k
        keep = enough[:, None]
        over = np.where(keep, over, found)
        equal = np.where(keep, hit, equal & ~total[at])
        level[enough] += 1 << at
    level = np.maximum(level - slack, 0)
    over, equal = np.zeros_like(valid), valid.copy()
    for at in range(len(total) - 1, -1, -1):
        one = np.array([(int(x) >> at) & 1 for x in level], bool)[:, None]
        over = np.where(one, over, over | (equal & total[at]))
        equal = np.where(one, equal & total[at], equal & ~total[at])
    return over | equal


def exact_scores(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Inner products of rows with one query; Python integers where a long could overflow."""
    bound = np.abs(values.astype(float)) @ np.abs(weights.astype(float))
    if bound.max(initial=0) < LIMIT:
        return values.astype(np.int64) @ weights
    return values.astype(object) @ weights.astype(object)


def search_block(ids, values, slices, dropped, query_ids, queries, k):
    """For each query its k best rows of the block: (query place, row place, score)."""
    n = len(values)
    words = -(-n // 64)
    full = np.zeros(words * 64, bool)
    full[:n] = True
    full = np.packbits(full, bitorder="little").view(np.uint64)
    found_q, found_r, found_s = [], [], []
    for first in range(0, len(queries), TILE_QUERIES):
        tile = queries[first : first + TILE_QUERIES]
        valid = np.repeat(full[None, :], len(tile), axis=0)
        own = ids[None, :] == query_ids[first : first + TILE_QUERIES, None]
        for q, r in zip(*np.nonzero(own), strict=True):
            valid[q, r >> 6] &= ~np.uint64(1 << (int(r) & 63))
        total, sizes = sum_slices(slices, tile)
        # Dropped parts move a score by less than this many units of the sum.
        slack = sizes.astype(object).sum(axis=1) * ((1 << dropped) - 1) >> dropped
        chosen = at_least(total, valid, k, slack)
        for q in range(len(tile)):
            rows = np.flatnonzero(np.unpackbits(chosen[q].view(np.uint8), bitorder="little"))
            scores = exact_scores(values[rows], tile[q])
            best = np.lexsort((ids[rows], -scores))[:k]
            found_q.append(np.full(len(best), first + q))
            found_r.append(rows[best])
            # A score beyond a long raises here.
            found_s.append(scores[best].astype(np.int64))
    if not found_q:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(found_q), np.concatenate(found_r), np.concatenate(found_s)


def build_index(vectors: DataFrame, path: str, scale=SCALE, dropped=DROPPED, rows=BLOCK_ROWS) -> DataFrame:
    """Packs (id, vector) rows into blocks stored at ``path``; no row is shuffled."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for no, (dim, width, ids, matrix) in enumerate(gathered(batches, scale, rows)):
            row = {
                "dim": dim, "part": part, "no": no, "width": width, "ids": ids.tobytes(),
                "values": matrix.astype(f"i{width}").tobytes(), "slices": slice_block(matrix, dropped).tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], BLOCKS)

    vectors.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)
    return vectors.sparkSession.read.parquet(path)


BLOCKS = pa.schema([
    ("dim", pa.int32()), ("part", pa.int32()), ("no", pa.int32()), ("width", pa.int32()),
    ("ids", pa.binary()), ("values", pa.binary()), ("slices", pa.binary()),
])


def top_k(index: DataFrame, queries: DataFrame, k: int, scale=SCALE, dropped=DROPPED, chunk=CHUNK_QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best rows of each query.

    ``queries`` holds (id, vector). A block is one row of ``index``; each chunk of
    queries is sent once to each block, which is what comparing all queries with all
    rows takes. Only k rows for each query and block leave a task.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, _, ids, matrix in gathered(batches, scale, chunk):
            row = {"dim": dim, "ids": ids.tobytes(), "values": matrix.tobytes()}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("values", pa.binary())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                ids = np.frombuffer(row["ids"], np.int64)
                values = np.frombuffer(row["values"], f"i{row['width']}").reshape(len(ids), dim)
                words = -(-len(ids) // 64)
                slices = np.frombuffer(row["slices"], np.uint64)
                slices = slices.reshape(dim, len(slices) // max(dim * words, 1), words)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                weights = np.frombuffer(row["query_values"], np.int64).reshape(len(query_ids), dim)
                q, r, score = search_block(ids, values, slices, dropped, query_ids, weights, k)
                # Queries of one id but other vectors are ranked apart.
                which = np.array([hash(weights[i].tobytes()) for i in range(len(weights))], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (query_ids[q], which[q], ids[r], score)],
                    ["query_id", "which", "vec_id", "score"],
                )

    name, vector = queries.columns
    packed = queries.dropDuplicates([name, vector]).mapInArrow(chunks, CHUNK_SCHEMA)
    places = index.select("dim", "part", "no")
    sent = packed.withColumnsRenamed({"ids": "query_ids", "values": "query_values"}).join(places, "dim")
    pairs = index.join(sent, ["dim", "part", "no"])
    found = pairs.mapInArrow(search, "query_id long, which long, vec_id long, score long")
    order = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
