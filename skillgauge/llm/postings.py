"""Positional postings of texts, packed by shard and term.

A shard is a run of at most ``SHARD_ROWS`` rows of one input partition with at most
``SHARD_WORDS`` words; a longer row is a shard of its own. The words of a shard's rows lie on one line of
places, with ``GAP`` empty places after each row, so that neither a phrase nor a
neighbourhood reaches from one row into the next. The index has one row for each shard
and term with the places of the term, and one row for each shard without a term, which
lists the shard's rows.

Words are runs of digits, letters a-z (A-Z are lower-cased) and all characters beyond
ASCII. A null text has no words. Rows are told apart by shard and number, so that rows
of one id, or without an id, stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_WORDS = 2**21
SHARD_ROWS = 2**16
GAP = 64

INDEX_SCHEMA = "shard long, term string, n long, df long, places binary, ids binary, sizes binary"
_INDEX = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64()),
    ("places", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary()),
])

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = ((_BYTES >= ord("0")) & (_BYTES <= ord("9"))) | ((_BYTES >= ord("a")) & (_BYTES <= ord("z"))) | (_BYTES >= 128)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many each text has.

    Separators are ASCII, so bytes can be looked at one by one.
    """
    texts = texts.cast(pa.string()).fill_null("")
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    lower = _LOWER[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]]
    ends = ends - ends[0]
    inside = _IN_WORD[lower]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < ends[1:]]
    first[heads] = inside[heads]
    sizes = np.diff(np.searchsorted(np.flatnonzero(first), ends))
    kept = lower[inside]
    starts = np.append(np.flatnonzero(first[inside]), len(kept)).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(kept))]
    )
    return words, sizes


def binary_rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``values`` cut into binary cells of ``counts`` values each."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    if ends[-1] >= 2**31:
        ends = pa.py_buffer(ends.astype(np.int64))
        wide = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, ends, pa.py_buffer(values)])
        return wide.cast(pa.binary())
    ends = pa.py_buffer(ends.astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, ends, pa.py_buffer(values)])


def row_starts(sizes: np.ndarray) -> np.ndarray:
    """First place of each row of a shard."""
    room = sizes.astype(np.int64) + GAP
    return np.cumsum(room) - room


def pack_shard(shard: int, ids: pa.Array, words: pa.Array, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Index rows of one shard."""
    coded = words.dictionary_encode()
    codes, terms = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(codes)) + GAP * row
    order = np.argsort(codes, kind="stable")
    n = np.bincount(codes, minlength=len(terms)) if len(codes) else np.zeros(0, np.int64)
    code_of, row_of = codes[order], row[order]
    new_row = np.ones(len(order), bool)
    new_row[1:] = (code_of[1:] != code_of[:-1]) | (row_of[1:] != row_of[:-1])
    df = np.bincount(code_of[new_row], minlength=len(terms)) if len(codes) else n
    size = len(terms)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, shard, np.int64)), terms, pa.array(n.astype(np.int64)), pa.array(df.astype(np.int64)),
            binary_rows(place[order].astype(np.int32), n), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()),
        ],
        schema=_INDEX,
    )
    listed = ids.cast(pa.string()).to_pylist()
    head = {
        "shard": shard, "term": None, "n": len(words), "df": int((sizes > 0).sum()), "places": None,
        "ids": ",".join("" if x is None else x for x in listed).encode(), "sizes": sizes.astype(np.int32).tobytes(),
    }
    yield pa.RecordBatch.from_pylist([head], _INDEX)


def build_index(docs: DataFrame, id_name: str, text_name: str, path: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index of all rows, stored at ``path``. No row is shuffled: each task packs
    its own partition, one shard in memory at a time. Ids are integers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, held, n_held, n_rows = TaskContext.get().partitionId() << 32, 0, [], 0, 0

        def whole():
            ids, words, sizes = zip(*held, strict=True)
            yield from pack_shard(part + no, pa.concat_arrays(ids), pa.concat_arrays(words), np.concatenate(sizes))

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            words, sizes = split_words(texts)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < len(ids):
                to = int(np.searchsorted(ends, ends[at] + shard_words - n_held, side="right")) - 1
                to = min(max(to, at if held else at + 1), at + SHARD_ROWS - n_rows, len(ids))
                if to > at:
                    held.append((ids[at:to], words[ends[at] : ends[to]], sizes[at:to]))
                    n_held, n_rows = n_held + int(ends[to] - ends[at]), n_rows + to - at
                at = to
                if at < len(ids):
                    yield from whole()
                    no, held, n_held, n_rows = no + 1, [], 0, 0
        if held:
            yield from whole()

    docs.select(F.col(id_name).cast("long"), F.col(text_name)).mapInArrow(pack, INDEX_SCHEMA).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def indexed_rows(index: DataFrame) -> DataFrame:
    """``shard``, ``row``, ``id``, ``n_words`` of every row in the index."""
    schema = pa.schema([("shard", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for head in batch.to_pylist():
                sizes = np.frombuffer(head["sizes"], np.int32).astype(np.int64)
                ids = [int(x) if x else None for x in head["ids"].decode().split(",")]
                shard = np.full(len(sizes), head["shard"], np.int64)
                columns = [pa.array(shard), pa.array(np.arange(len(sizes))), pa.array(ids, pa.int64()), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    heads = index.where("term is null").select("shard", "ids", "sizes")
    return heads.mapInArrow(rows, "shard long, row long, id long, n_words long")
