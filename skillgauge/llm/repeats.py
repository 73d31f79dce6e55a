"""Substring dedup: repeated word windows found in FM-indexes, shard by shard.

Each window of words is filed under its smallest n-gram (by hash), so equal windows
meet. A run of windows under one n-gram is a segment. Equal segments are folded to
their first place before anything is indexed; every later one is a repeat as a whole.
Where different segments share an n-gram, their words go to the shard of that n-gram.
A shard keeps them as an FM-index over a wavelet tree; backward search gives, for all
windows at once, the interval of their occurrences and so the earliest one.

Defined cases: a null text has no words; texts shorter than a window keep all; rows
of one doc_id with equal texts stand at the same place and so do not repeat each
other; a null doc_id comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
GRAM = 10
BLOCK_WORDS = 100_000
KNOWN_WORDS = 200_000
#: A segment has at most this many words: windows that share an n-gram.
LONGEST = 2 * WINDOW - GRAM
FACTORS = np.random.default_rng(11).integers(1, 2**63, GRAM + LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NO_ID = -(2**63)


class WordHashes(dict):
    """Hashes of words, kept for those met before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


def segments(words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, words, n-gram and digest of each run of windows under one n-gram."""
    count = len(words) - WINDOW + 1
    if count < 1:
        return (np.zeros(0, np.int64),) * 4
    hashed = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = len(words) - GRAM + 1
    with np.errstate(over="ignore"):
        grams = np.zeros(size, np.uint64)
        for k in range(GRAM):
            grams += hashed[k : size + k] * FACTORS[k]
        grams = (grams ^ (grams >> np.uint64(31))) * FACTORS[0]
        grams ^= grams >> np.uint64(29)
    reach = WINDOW - GRAM + 1
    least = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(count)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    sizes = np.diff(np.r_[first, count]) + WINDOW - 1
    with np.errstate(over="ignore"):
        digests = sizes.astype(np.uint64) * FACTORS[1]
        for k in range(LONGEST):
            # Places behind a segment's end add nothing.
            at = np.minimum(first + k, len(words) - 1)
            digests += np.where(k < sizes, hashed[at], np.uint64(0)) * FACTORS[GRAM + k]
        digests = (digests ^ (digests >> np.uint64(31))) * FACTORS[2]
        digests ^= digests >> np.uint64(29)
    return first, sizes, grams[least[first]].view(np.int64), digests.view(np.int64)


class WaveletTree:
    """Ranks of symbols in a sequence; each level orders it by one more bit."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            before = np.r_[0, np.cumsum(~ones)]
            self.levels.append((bit, before))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start, end = np.zeros_like(place), place.copy()
        for bit, before in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            zeros = before[-1]
            start = np.where(one, zeros + start - before[start], before[start])
            end = np.where(one, zeros + end - before[end], before[end])
        return end - start


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by doubling of sorted prefixes."""
    n, step = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        new = np.r_[0, np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]
        rank[order] = new
        if new[-1] == n - 1 or step > WINDOW * 4:
            return order
        step *= 2


class FmIndex:
    def __init__(self, symbols: np.ndarray) -> None:
        """``symbols`` are from 1 up; a 0 ends each text, so no window crosses one."""
        self.order = suffix_order(symbols)
        size = int(symbols.max()) + 1
        self.first = np.searchsorted(np.sort(symbols), np.arange(size + 1))
        self.tree = WaveletTree(symbols[self.order - 1], max(size - 1, 1).bit_length())

    def intervals(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all rows of ``patterns`` at once."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.order), np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[:, k]
            low = self.first[symbol] + self.tree.rank(symbol, low)
            high = self.first[symbol] + self.tree.rank(symbol, high)
        return low, high


def repeated_windows(texts: list[list[str]]) -> list[list[int]]:
    """For each text, the starts of windows that occur earlier in the given order."""
    names: dict[str, int] = {}
    coded = [np.array([names.setdefault(w, len(names) + 1) for w in words], np.int64) for words in texts]
    whole = np.concatenate([np.r_[c, 0] for c in coded])
    starts = np.cumsum([0] + [len(c) + 1 for c in coded[:-1]])
    places = np.concatenate([s + np.arange(len(c) - WINDOW + 1) for s, c in zip(starts, coded, strict=True)])
    index = FmIndex(whole)
    low, high = index.intervals(whole[places[:, None] + np.arange(WINDOW)])
    bounds = np.stack([low, high], axis=1).ravel()
    earliest = np.minimum.reduceat(np.r_[index.order, len(whole)], bounds)[::2]
    late = places[earliest < places]
    owner = np.searchsorted(starts, late, "right") - 1
    out: list[list[int]] = [[] for _ in texts]
    for who, at in zip(owner, late - starts[owner], strict=True):
        out[who].append(int(at))
    return out


def repeated_grams(found: DataFrame) -> DataFrame:
    """The rows of ``found`` whose n-gram occurs more than once.

    They are shuffled once, and what occurs once is left out in passing.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, twice = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            gram = table["gram"].to_numpy()
            same = gram[1:] == gram[:-1]
            keep = np.r_[twice, same] | np.r_[same, False]
            yield from table.filter(pa.array(np.r_[keep[:-1], False])).to_batches()
            # The next batch tells whether the last row's n-gram comes again.
            held, twice = table.slice(len(gram) - 1).to_batches()[0], bool(keep[-1])
        if held is not None and twice:
            yield held

    dealt = found.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(rows, found.schema)


def _words(texts: pa.Array) -> Iterator[list[bytes]]:
    """Words of each text. Splitting bytes takes space and 0x09 to 0x0D, and no others."""
    return (text.split() for text in texts.cast(pa.binary()).to_pylist())


def _spans(starts: list[int]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for at in starts:
        if found and at <= found[-1][1]:
            found[-1] = (found[-1][0], at + WINDOW)
        else:
            found.append((at, at + WINDOW))
    return found


def remove_repeats(docs: DataFrame, path) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (joined by spaces) of each row.

    ``path()`` names a new place in the shared folder for each stored step.
    """
    spark = docs.sparkSession

    def stored(rows: DataFrame) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(at := path())
        return spark.read.parquet(at)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [segments(words, hashes) for words in _words(part.column(2))]
                many = [len(f[0]) for f in found]
                columns = [np.repeat(part.column(k).to_numpy(), many) for k in (0, 1)]
                columns += [np.concatenate(c) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "row", "start", "size", "gram", "digest"])

    def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    keyed = docs.select(
        doc.alias("doc_id"), F.coalesce(doc, F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text")
    )
    found = keyed.select("doc", "row", "text").mapInArrow(cut, "doc long, row long, start long, size long, gram long, digest long")
    # Only n-grams that occur again can hold a repeat. The others are shuffled, never stored.
    found = stored(repeated_grams(found))
    firsts = stored(found.groupBy("gram", "digest").agg(F.min(F.struct("doc", "row", "start", "size")).alias("first")))
    later = found.join(firsts, ["gram", "digest"]).where("doc <> first.doc OR start <> first.start")
    whole = later.select("doc", "row", F.struct("start", (F.col("start") + F.col("size")).alias("end")).alias("span"))

    several = firsts.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram")
    wanted = firsts.join(several, "gram").groupBy("first.doc", "first.row").agg(
        F.collect_list(F.struct("first.start", "first.size", "gram")).alias("parts")
    )

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), _words(batch.column(2)), batch.column(3).to_pylist())
            for doc, row, words, parts in zip(*rows, strict=True):
                bodies = [b"\n".join(words[p["start"] : p["start"] + p["size"]]).decode() for p in parts]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["gram"] for p in parts], pa.int64()), pa.array([doc] * n, pa.int64()), pa.array([row] * n, pa.int64()),
                     pa.array([p["start"] for p in parts], pa.int64()), pa.array(bodies, pa.string())],
                    ["gram", "doc", "row", "start", "body"],
                )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(block: list[dict]) -> pa.RecordBatch:
            # Within a shard text order is document order, so the least place is the earliest.
            block.sort(key=lambda r: (r["doc"], r["start"], r["row"]))
            out = []
            for r, starts in zip(block, repeated_windows([r["body"].split("\n") for r in block]), strict=True):
                out += [(r["doc"], r["row"], r["start"] + a, r["start"] + b) for a, b in _spans(starts)]
            return _batch(out, ["doc", "row", "start", "end"])

        block: list[dict] = []
        size, gram = 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if size >= BLOCK_WORDS and r["gram"] != gram:
                    yield flush(block)
                    block, size = [], 0
                gram = r["gram"]
                block.append(r)
                size += r["body"].count("\n") + 1
        if block:
            yield flush(block)

    once = keyed.select("doc", "row", "text").dropDuplicates(["doc", "row"])
    bodies = once.join(wanted, ["doc", "row"]).select("doc", "row", "text", "parts").mapInArrow(
        words_of, "gram long, doc long, row long, start long, body string"
    )
    near = bodies.repartition("gram").sortWithinPartitions("gram").mapInArrow(index, "doc long, row long, start long, end long")
    spans = whole.union(near.select("doc", "row", F.struct("start", "end").alias("span")))
    by_doc = spans.groupBy("doc", "row").agg(F.collect_list("span").alias("spans"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            found = (batch.column(0).to_pylist(), _words(batch.column(1)), batch.column(2).to_pylist())
            for doc_id, words, spans in zip(*found, strict=True):
                if not spans:
                    rows.append((doc_id, len(words), 0, b" ".join(words).decode()))
                    continue
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["start"]] += 1
                    gone[s["end"]] -= 1
                keep = (np.cumsum(gone)[:-1] == 0).tolist()
                kept = [w for w, k in zip(words, keep, strict=True) if k]
                rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_words", "n_removed", "kept"]
            )

    joined = keyed.join(by_doc, ["doc", "row"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept string")
