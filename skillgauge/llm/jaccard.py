"""Exact n-gram Jaccard join at a threshold, by set-relation skipping.

Equal sets are folded first; one document stands for each. Sets are indexed under
their rarest shingles (a prefix long enough that two sets which link share one of
them). The index goes a little beyond that prefix; two sets that link then share several
entries, so sets with few shared ones, and some entries of all others, are left out.
An entry also needs another one of a fitting size in its list. A list is cut into blocks by size class, and a block meets only those whose
sizes fit; inside, runs of neighbouring places are skipped whole where no pair of
them can still overlap enough. A block holds a bounded number of sets, so a list of
any length is dealt to many tasks. Only components are computed, not all links.

Lists that hold the same sets are folded to one. Answers are derived from those of a
similar set: each list has a pivot, a set is compared with one pivot a round, and
sets linked to the same pivot need not be compared with each other. As Jaccard
distance is a metric, a pair whose distances to one pivot differ by more than the
threshold allows is skipped too. Only lists that still hold sets of several
components are read in blocks.

Each set has a sketch: bit h mod 512 flips for every shingle h. Two sketches differ
in at most as many bits as the sets differ in shingles, so a pair whose sketches
differ by too much cannot link and its texts are never read. No link is lost by it.
A wide sketch has about as many bits as its set has shingles (half of that for large
sets), so that it also tells large sets apart; the wider of two is folded. Pairs of sets
and pivots are tested by both. Where all pairs of a list are compared, only the wide one
is used, and a pair is given in the first of its lists. Texts are packed and shuffled
only if a filter of bounded size holds their ids.

Which shingles count as frequent only changes the order, never the result. Shingles
are compared by 64-bit hashes.

Defined cases: a null text, or one without words, has no shingles and links with
nothing; fewer words than a shingle has make one shingle; rows of one doc_id stand
for one document of which each version links; a null doc_id forms a group of its own
with its equals.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
WORDS = 5
SHARE = (4, 5)
FREQUENT = 50_000
BLOCK_SETS = 2_000
PIVOT_ROUNDS = 2
GROUP_SETS = 500
LIST_SETS = 4_000
RUN_SETS = 256
SKETCH_WORDS = 8
WIDEST = 1024
LARGE_SET = 4_000
EARLIER = 8
SKETCHES_AT_ONCE = 128 * 1024
SPARE = (2, 5)
BLOCK_BYTES = 256 * 1024
LONG_WORD = 64
CLASS_BITS = 20
FILTER_BITS = (2**10, 2**27)
FACTORS = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GAP = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """``x``, changed in place, with its bits spread."""
    x ^= x >> np.uint64(31)
    x *= FACTORS[40]
    x ^= x >> np.uint64(29)
    return x


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``data`` that stand at ``starts`` to ``ends``."""
    padded = data + bytes(8)
    eights = np.ndarray(len(data) + 1, np.uint64, padded, strides=(1,))
    length = ends - starts
    hashed = length.astype(np.uint64) * FACTORS[41]
    left = np.flatnonzero(length <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        left = left[length[left] > done] if done else left
        if not len(left):
            break
        part = eights[starts[left] + done] & BYTES[np.minimum(length[left] - done, 8)]
        hashed[left] = _mixed((hashed[left] ^ part) * FACTORS[42])
    for k in np.flatnonzero(length > LONG_WORD):
        hashed[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]])
    return hashed


def shingle_rows(texts: list[bytes | None], size: int = WORDS) -> list[np.ndarray]:
    """64-bit hashes of the shingles of each text, in their order, with repeats."""
    with np.errstate(over="ignore"):
        data = b"\n" + b"\n".join([t or b"" for t in texts]).lower() + b"\n"
        inside = ~GAP[np.frombuffer(data, np.uint8)]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[0::2], edges[1::2]
        hashed = word_hashes(data, starts, ends)

        def rows(words: np.ndarray, size: int) -> np.ndarray:
            total = np.full(len(words) - size + 1, FACTORS[32 + size], np.uint64)
            for k in range(size):
                total += words[k : len(words) - size + 1 + k] * FACTORS[k]
            return _mixed(total)

        whole = rows(hashed, size) if len(hashed) >= size else hashed[:0]
        places = np.cumsum([1, *(len(t or b"") + 1 for t in texts)])
        at = np.searchsorted(starts, places).tolist()
        found = []
        for first, last in zip(at[:-1], at[1:], strict=True):
            if last - first >= size:
                found.append(whole[first : last - size + 1])
            else:
                found.append(rows(hashed[first:last], last - first) if last > first else hashed[:0])
        return found


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted ``hashes`` without repeats."""
    hashes = np.sort(hashes)
    return hashes[np.r_[True, hashes[1:] != hashes[:-1]]] if len(hashes) else hashes


def text_blocks(texts: pa.Array, size: int, sets: int = BLOCK_SETS) -> Iterator[list[np.ndarray]]:
    """``shingle_rows`` of the texts, of at most ``sets`` texts and some ``BLOCK_BYTES`` at once."""
    held, used = [], 0
    for text in texts:
        raw = (text.as_py() or "").encode()
        if held and (used + len(raw) > BLOCK_BYTES or len(held) == sets):
            yield shingle_rows(held, size)
            held, used = [], 0
        held.append(raw)
        used += len(raw)
    if held:
        yield shingle_rows(held, size)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    return distinct(shingle_rows([(text or "").encode()], size)[0])


def prefix_length(n: int, share: tuple[int, int]) -> int:
    """Any set that links with one of ``n`` shingles shares one of its first so many."""
    return n - -(-n * share[0] // share[1]) + 1


def spare_length(n: int, share: tuple[int, int]) -> int:
    """Shingles that are indexed beyond the prefix; it never falls as ``n`` grows."""
    return prefix_length(n, share) * SPARE[0] // SPARE[1]


def frequent_classes(docs: DataFrame, size: int, limit: int = FREQUENT) -> np.ndarray:
    """A class by frequency for each value of a hash's first ``CLASS_BITS`` bits, 0 if rare.

    It is that of the most frequent of up to ``limit`` shingles. Blocks of documents
    leave out what they hold less than three times, so little is shuffled. The order
    of shingles needs no exact counts.
    """

    def often(blocks: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.sort(np.concatenate(blocks))
        # A shingle held n times is met n - 2 times here.
        names, n = np.unique(whole[2:][whole[2:] == whole[:-2]], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n + 2)], ["name", "n"])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_SETS):
                texts = batch.column(0).slice(first, BLOCK_SETS)
                yield often([distinct(x) for sets in text_blocks(texts, size) for x in sets])

    found = (
        docs.select("text").mapInArrow(counts, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "name").limit(limit).toArrow()
    )
    names, n = found["name"].to_numpy().view(np.uint64)[::-1], found["n"].to_numpy()[::-1]
    classes = np.zeros(1 << CLASS_BITS, np.uint8)
    classes[(names >> np.uint64(64 - CLASS_BITS)).astype(np.int64)] = np.log2(n.astype(float)).astype(np.uint8) + 1
    return classes


def sketch(found: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parities of a set's shingles over ``words`` * 64 bits."""
    bits = np.bincount((found % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketch_words(n: int) -> int:
    """Words of the wide sketch of a set: the next power of two that gives a bit a shingle.

    Large sets are told apart by half of that: unlike ones differ in a quarter of ``n``
    bits or more, give or take far less than what is left to two ninths.
    """
    words = SKETCH_WORDS
    while words * 64 < (n if n < LARGE_SET else n / 2) and words < WIDEST:
        words *= 2
    return words


def narrowed(marks: np.ndarray, words: int) -> np.ndarray:
    """Wide sketches, one a row, as they would be with so many ``words``."""
    while marks.shape[1] > words:
        half = marks.shape[1] // 2
        marks = marks[:, :half] ^ marks[:, half:]
    return marks


def described_sets(docs: DataFrame, size: int, share: tuple[int, int]) -> DataFrame:
    """``doc_id``, ``n``, a digest of the whole set, its prefix from the rarest on, and
    its sketch."""
    classes = docs.sparkSession.sparkContext.broadcast(frequent_classes(docs, size))

    def lists(parts: list[np.ndarray | None]) -> pa.ListArray:
        ends = np.cumsum([0, *(0 if x is None else len(x) for x in parts)])
        values = np.concatenate([np.zeros(0, np.int64), *(x for x in parts if x is not None)])
        none = pa.array([x is None for x in parts], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=none)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for block in text_blocks(batch.column(1), size):
                n, keys, prefixes, sketches, wide = [], [], [], [], []
                for found in map(distinct, block):
                    n.append(len(found))
                    if not len(found):
                        for held in (keys, prefixes, sketches, wide):
                            held.append(None)
                        continue
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    rank = classes.value[(found >> np.uint64(64 - CLASS_BITS)).astype(np.int64)]
                    # Hashes are in order, and stay so within a class.
                    order = np.argsort(rank, kind="stable")[: prefix_length(len(found), share) + spare_length(len(found), share)]
                    prefixes.append(found[order].view(np.int64))
                    wide.append(sketch(found, sketch_words(len(found))))
                    sketches.append(narrowed(wide[-1][None, :], SKETCH_WORDS)[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(n)), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                        lists(prefixes), lists(sketches), lists(wide),
                    ],
                    ["doc_id", "n", "key", "prefix", "sketch", "wide"],
                )
                first += len(n)

    schema = "doc_id long, n long, key binary, prefix array<long>, sketch array<long>, wide array<long>"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def alike(n: Column, marks: Column, other_n: Column, other_marks: Column, share: tuple[int, int]) -> Column:
    """Whether two sketches still allow a link."""
    bits = F.zip_with(marks, other_marks, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differing = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    return differing * (share[0] + share[1]) <= (n + other_n) * (share[1] - share[0])


def alike_wide(n: Column, marks: Column, other_n: Column, other_marks: Column, share: tuple[int, int]) -> Column:
    """``alike`` for sketches of which one may have twice the words; others are let pass."""

    def halved(marks: Column, words: Column) -> Column:
        folded = F.zip_with(F.slice(marks, 1, words), F.slice(marks, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(marks) == words * 2, folded).otherwise(marks)

    words = F.least(F.size(marks), F.size(other_marks))
    near = alike(n, halved(marks, words), other_n, halved(other_marks, words), share)
    return (F.greatest(F.size(marks), F.size(other_marks)) > words * 2) | near


def fits(n: Column, place: Column, other_n: Column, other_place: Column, share: tuple[int, int]) -> Column:
    """Whether sizes, and the places of a shingle that both hold, still allow a link."""
    most = 1 + F.least(n - place - 1, other_n - other_place - 1) + F.least(place, other_place)
    sizes = F.least(n, other_n) * share[1] >= F.greatest(n, other_n) * share[0]
    return sizes & (most * (share[0] + share[1]) >= (n + other_n) * share[0])


def shared_entries(entries: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``entries`` (token, id, n, place) whose token another entry of a fitting size holds.

    Along the sizes of a token the nearest is the one before or after, so a pair of
    sizes that fit is never lost.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            both = [batch] if held is None else [held, batch]
            table = pa.Table.from_batches(both).combine_chunks()
            token, n = table["token"].to_numpy(), table["n"].to_numpy()
            near = (token[1:] == token[:-1]) & (n[:-1] * share[1] >= n[1:] * share[0])
            keep = np.r_[before, near] | np.r_[near, False]
            yield from table.filter(pa.array(np.r_[keep[:-1], False])).to_batches()
            # The next batch tells whether the last row has a neighbour there.
            held, before = table.slice(len(token) - 1).to_batches()[0], bool(keep[-1])
        if held is not None and before:
            yield held

    dealt = entries.select("token", "id", "n", "place").repartition("token").sortWithinPartitions("token", "n")
    return dealt.mapInArrow(rows, "token long, id binary, n long, place int")


def needed_entries(entries: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``entries`` (token, id, n, place) without the last of each set, as many as are spare.

    Of two sets that link, all common shingles but those behind the shorter index stand
    in both, so they share one more entry than the smaller has spare. When each leaves out
    its last ones in the common order, no more than the smallest set that fits it
    has spare, one common entry is still held by both. Sets with hardly any shared entry,
    as unlike texts have, are left out whole.
    """
    up, down = share[1] - 1, share[1]
    least = f"((n * {share[0]} + {up}) div {down})"
    spare = F.expr(f"(({least} - ({least} * {share[0]} + {up}) div {down} + 1) * {SPARE[0]}) div {SPARE[1]}")
    whole = Window.partitionBy("id")
    ranked = entries.dropDuplicates(["id", "token"]).withColumns(
        {"rank": F.row_number().over(whole.orderBy("place")), "held": F.count("*").over(whole)}
    )
    return ranked.where(F.col("rank") <= F.col("held") - spare).select("token", "id", "n", "place")


def folded_lists(lists: DataFrame) -> DataFrame:
    """``lists`` without those of one set, and one of each group that hold the same sets.

    Near copies share most of their shingles, so most lists repeat another one. The
    one kept has the rarest places, at which skipping works best.
    """
    # One exchange serves the marks and the join below.
    lists = lists.repartition("token")
    # Sums of hash halves stay within a long and need no sorting.
    one, two = F.xxhash64("id"), F.xxhash64("id", F.lit(1))
    low, high = F.lit(0xFFFFFFFF), 32
    sums = [F.sum(part).alias(f"sum{no}") for no, part in enumerate(
        [one.bitwiseAND(low), F.shiftright(one, high), two.bitwiseAND(low), F.shiftright(two, high)]
    )]
    marks = lists.groupBy("token").agg(
        F.count("*").alias("m"), F.min(one).alias("low"), F.max(one).alias("high"), F.max("place").alias("deep"), *sums
    )
    same = ("m", "low", "high", "sum0", "sum1", "sum2", "sum3")
    kept = marks.where("low <> high").groupBy(*same).agg(F.min_by("token", F.struct("deep", "token")).alias("token"))
    return lists.join(kept.select("token"), "token")


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits, a power of two, set for the hashes of ``ids`` (one column).

    There are some 32 bits an id, at most 16 MB in all, so it may go to the driver and
    to all tasks; when it fills up, more texts than wanted pass and are left out later.
    """
    least, most = FILTER_BITS
    bits = min(max(least, 1 << (32 * ids.count() + 1).bit_length()), most)
    slot = F.xxhash64(ids.columns[0]).bitwiseAND(F.lit(bits - 1))
    words = ids.select(slot.alias("slot")).selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, cast(slot & 63 AS int)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    marks = np.zeros(bits // 64, np.int64)
    marks[found["word"].to_numpy()] = found["bits"].to_numpy()
    return marks.view(np.uint64)


def packed_texts(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``id`` and packed ``body`` of the sets in ``wanted`` (id, key, first).

    Only texts that a filter of the wanted ids lets pass are packed and shuffled.
    """
    marks = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("first")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            slot = batch.column(0).to_numpy().view(np.uint64) & np.uint64(len(marks.value) * 64 - 1)
            word = marks.value[(slot >> np.uint64(6)).astype(np.int64)]
            some = batch.filter(pa.array((word >> (slot & np.uint64(63))) & np.uint64(1) == 1))
            for first in range(0, some.num_rows, RUN_SETS):
                part = some.slice(first, RUN_SETS)
                names, keys, bodies = [], [], []
                for name, text in zip(part.column(1), part.column(2), strict=True):
                    text = text.as_py() or ""
                    names.append(name.as_py())
                    keys.append(hashlib.blake2b(shingles(text, size).tobytes(), digest_size=16).digest())
                    bodies.append(pack(b" ".join(WORD.findall(text.encode().lower()))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], ["doc_id", "at", "body"]
                )

    packed = docs.select(F.xxhash64("doc_id").alias("slot"), "doc_id", "text").mapInArrow(rows, "doc_id long, at binary, body binary")
    # Rows that share a doc_id but not a text are told apart by the digest.
    same = (F.col("at") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("first"))
    return packed.join(wanted, same).dropDuplicates(["key"]).select("id", "body")


def distances(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, share: tuple[int, int], size: int, stored) -> DataFrame:
    """``pairs`` (a, b) with ``distance`` and whether they link.

    Only texts of these pairs are read. Each ``a`` meets its partners in one group, or
    in several if it has many, so its text moves once a group and not once a pair.
    """
    pairs = stored(pairs)
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_SETS).alias("parts"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    asked = stored(
        dealt.select("a", "part", F.col("b").alias("id")).union(dealt.select("a", "part", F.col("a").alias("id")).distinct())
    )
    wanted = stored(asked.select("id").distinct().join(firsts, "id"))
    bodies = packed_texts(docs, wanted, size)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        x = np.zeros(0, np.uint64)
        for batch in batches:
            a, b, distance, linked = [], [], [], []
            for one, other, partner, body in zip(*batch.columns, strict=True):
                found = shingles(unpack(body.as_py()).decode(), size)
                if not partner.as_py():
                    x = found
                    continue
                small, large = (x, found) if len(x) <= len(found) else (found, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                union = len(small) + len(large) - both
                a.append(one.as_py())
                b.append(other.as_py())
                distance.append(1 - both / union)
                linked.append(both * share[1] >= union * share[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_())],
                ["a", "b", "distance", "linked"],
            )

    found = asked.join(bodies, "id").withColumn("partner", F.col("id") != F.col("a"))
    groups = found.select("a", "part", "partner", "id", "body").repartition("a", "part").sortWithinPartitions("a", "part", "partner")
    return groups.select("a", "id", "partner", "body").mapInArrow(rows, "a binary, b binary, distance double, linked boolean")


def components(edges: DataFrame, path) -> DataFrame:
    """``id`` and the smallest ``label`` reachable, from (a, b); each round is stored.

    Large-star and small-star steps in turn: neighbours move to the smallest one
    known, so a chain of n takes about log n rounds.
    """
    spark = edges.sparkSession

    def stored(rows: DataFrame) -> DataFrame:
        rows.write.parquet(at := path())
        return spark.read.parquet(at)

    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.select("a", F.col("low").alias("b")).union(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        current = stored(small.distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return current.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "id")
        before = state


def list_blocks(entries: DataFrame, share: tuple[int, int], limit: int) -> DataFrame:
    """``entries`` dealt to blocks of one list and size class of some ``limit`` sets each.

    Every set has a home block. It visits the later blocks of its class and all blocks
    of the class below it; sizes of other classes never fit.
    """
    # A little wider than the sizes that fit, so that rounding matters nowhere.
    step = 1.001 * float(np.log(share[1] / share[0]))
    entries = entries.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / step).cast("long"))
    parts = entries.groupBy("token", "class").agg(F.ceil(F.count("*") / limit).alias("parts"))
    dealt = entries.join(parts, ["token", "class"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    home = dealt.withColumn("visitor", F.lit(False))
    later = dealt.where("part + 1 < parts").withColumn("part", F.explode(F.sequence(F.col("part") + 1, F.col("parts") - 1)))
    below = parts.select("token", (F.col("class") + 1).alias("class"), F.col("parts").alias("below"))
    lower = dealt.join(below, ["token", "class"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("below") - 1)))
    visits = later.unionByName(lower.drop("below").withColumn("class", F.col("class") - 1))
    return home.unionByName(visits.withColumn("visitor", F.lit(True))).drop("parts")


def with_earlier(entries: DataFrame) -> DataFrame:
    """``entries`` with up to ``EARLIER`` tokens of the same set that come before, by value."""
    before = Window.partitionBy("id").orderBy("token").rowsBetween(-EARLIER, -1)
    return entries.withColumn("earlier", F.collect_list("token").over(before))


class Run:
    """Sets of one list with neighbouring places, and what bounds all of them."""

    def __init__(self, ids, labels, pivots, n, place, near, marks, earlier, held) -> None:
        self.ids, self.labels, self.pivots, self.earlier, self.held = ids, labels, pivots, earlier, held
        self.n, self.place, self.near, self.marks = n, place, near, marks
        self.least, self.most = int(n.min()), int(n.max())
        self.deep, self.after = int(place.max()), int((n - place).max())

    def skips(self, other: Run, share: tuple[int, int]) -> bool:
        """Whether sizes and places rule out every pair of two runs."""
        if min(self.most, other.most) * share[1] < max(self.least, other.least) * share[0]:
            return True
        best = min(self.after, other.after) + min(self.deep, other.deep)
        return best * (share[0] + share[1]) < (self.least + other.least) * share[0]

    def pairs(self, other: Run, share: tuple[int, int], gap: float) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the pairs that sizes, places, sketches and pivots allow."""
        n, m = self.n[:, None], other.n[None, :]
        best = np.minimum(n - self.place[:, None], m - other.place) + np.minimum(self.place[:, None], other.place)
        fit = np.minimum(n, m) * share[1] >= np.maximum(n, m) * share[0]
        i, j = np.nonzero(fit & (best * (share[0] + share[1]) >= (n + m) * share[0]))
        words = min(self.marks.shape[1], other.marks.shape[1])
        mine, theirs = narrowed(self.marks, words), narrowed(other.marks, words)
        bits = np.empty(len(i), np.int64)
        for at in range(0, len(i), step := max(1, SKETCHES_AT_ONCE // words)):
            some = slice(at, at + step)
            bits[some] = np.bitwise_count(mine[i[some]] ^ theirs[j[some]]).sum(axis=1, dtype=np.int64)
        near = bits * (share[0] + share[1]) <= (self.n[i] + other.n[j]) * (share[1] - share[0])
        i, j = i[near], j[near]
        # Distances to one pivot that differ by more than the gap rule out a link.
        far = (self.pivots[i] == other.pivots[j]) & (np.abs(self.near[i] - other.near[j]) > gap)
        open_pair = (self.labels[i] != other.labels[j]) & ~far.astype(bool)
        i, j = i[open_pair], j[open_pair]
        # Two sets that share an earlier list meet there: what is said of a pair is the
        # same in each of its lists, but for the places, which never rule out a link.
        met = np.zeros(len(i), bool)
        for k in range(self.earlier.shape[1]):
            same = (self.earlier[i, k, None] == other.earlier[j]) & self.held[i, k, None] & other.held[j]
            met |= same.any(axis=1)
        return i[~met], j[~met]


def mixed_pairs(entries: DataFrame, share: tuple[int, int], limit: int = LIST_SETS) -> DataFrame:
    """Pairs (a, b) of different components that share a list and may still link.

    ``entries``: token, n, id, place, label, pivot, distance (null: none) and sketch, of
    any widths that ``narrowed`` can make equal. A pair is given in the first of its
    lists, and again only where ``EARLIER`` tokens do not reach back to another one.
    """
    if "earlier" not in entries.columns:
        entries = with_earlier(entries)
    gap = 1 - share[0] / share[1] + 1e-9
    names = ("token", "class", "part", "visitor", "place", "n", "id", "label", "pivot", "distance", "sketch", "earlier")

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, bool, Run]]:
        """The batch cut where the block or the role changes, and after ``RUN_SETS`` sets."""
        token, kind, part, visitor, place, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
        ids, labels, pivots = (np.array(batch.column(k).to_pylist() + [None], object)[:-1] for k in range(6, 9))
        near = batch.column(9).fill_null(0.0).to_numpy(zero_copy_only=False)
        marks = batch.column(10).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        widths = batch.column(10).value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(widths) - widths
        counts = batch.column(11).value_lengths().to_numpy(zero_copy_only=False)
        reach = np.arange(EARLIER) < counts[:, None]
        earlier = np.zeros(reach.shape, np.int64)
        earlier[reach] = batch.column(11).flatten().to_numpy(zero_copy_only=False)
        # A set without a pivot is its own.
        pivots = np.where(np.equal(pivots, None), ids, pivots)
        new = (token[1:] != token[:-1]) | (kind[1:] != kind[:-1]) | (part[1:] != part[:-1]) | (visitor[1:] != visitor[:-1])
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(token)]
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            for at in range(start, stop, RUN_SETS):
                cut = slice(at, min(at + RUN_SETS, stop))
                block = (token[at], kind[at], part[at])
                # Sets of a block have much the same size, so little is folded.
                words = int(widths[cut].min())
                held = np.empty((cut.stop - at, words), np.uint64)
                for width in np.unique(widths[cut]):
                    some = np.flatnonzero(widths[cut] == width)
                    held[some] = narrowed(marks[first[cut][some, None] + np.arange(width)], words)
                run = Run(ids[cut], labels[cut], pivots[cut], n[cut].astype(np.int64), place[cut].astype(np.int64), near[cut], held, earlier[cut], reach[cut])
                yield block, bool(visitor[at]), run

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, home = None, []
        for batch in batches:
            left, right = [], []
            for at, visitor, run in runs(batch) if batch.num_rows else ():
                if at != block:
                    block, home = at, []
                for other in home:
                    if not run.skips(other, share):
                        i, j = run.pairs(other, share, gap)
                        left.extend(run.ids[i])
                        right.extend(other.ids[j])
                if not visitor:
                    if len(run.ids) > 1:
                        i, j = run.pairs(run, share, gap)
                        left.extend(run.ids[i[i < j]])
                        right.extend(run.ids[j[i < j]])
                    home.append(run)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    block = ("token", "class", "part")
    dealt = list_blocks(entries, share, limit).repartition(*block).sortWithinPartitions(*block, "visitor", "place")
    found = dealt.select(*names).mapInArrow(rows, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_components(
    docs: DataFrame, path, size: int = WORDS, share: tuple[int, int] = SHARE, rounds: int = PIVOT_ROUNDS, limit: int = LIST_SETS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    ``path()`` names a new place in the shared folder for each stored step. ``rounds``
    of pivots and the sets of a block change the plan only.
    """
    spark = docs.sparkSession

    def stored(rows: DataFrame) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(at := path())
        return spark.read.parquet(at)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = stored(described_sets(docs, size, share))
    # Equal sets are one from here on, named by their first document; by their digest
    # where that is null or the first of several sets.
    firsts = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    several = firsts.groupBy("first").agg((F.count("*") > 1).alias("several")).where("several")
    short = F.unhex(F.lpad(F.hex("first"), 16, "0"))
    firsts = firsts.join(several, "first", "left")
    firsts = stored(firsts.select("key", "first", F.when(F.col("several"), F.col("key")).otherwise(F.coalesce(short, "key")).alias("id")))
    sets = members.join(firsts.withColumnRenamed("key", "at"), (F.col("key") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first")))
    lists = stored(shared_entries(sets.select("id", "n", F.posexplode("prefix").alias("place", "token")), share))
    lists = stored(needed_entries(lists.repartition("id"), share))
    lists = stored(folded_lists(lists))
    # Repeated rows of one document hold the same set.
    marks = stored(sets.select("id", "n", "sketch", "wide").join(lists.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]))
    lists = stored(lists.join(marks.select("id", "sketch"), "id"))
    wide = marks.select("id", F.col("wide").alias("sketch"))
    pivot_marks = marks.select(F.col("id").alias("named"), F.col("n").alias("size"), F.col("wide").alias("marks"))

    linked = spark.createDataFrame([], "a binary, b binary")
    nearest = spark.createDataFrame([], "id binary, pivot binary, distance double")
    labels = spark.createDataFrame([], "id binary, label binary")
    for turn in range(rounds):
        state = lists.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        # A pivot of another component each time, drawn by a hash.
        draw = F.struct(F.xxhash64("id", F.lit(turn)).alias("drawn"), "id", "n", "place", "label")
        spans = F.min("label") != F.max("label")
        pivots = state.groupBy("token").agg(F.min(draw).alias("p"), spans.alias("open")).where("open").drop("open")
        sketches = lists.select(F.col("id").alias("named"), F.col("sketch").alias("marks")).dropDuplicates(["named"])
        pivots = pivots.join(sketches, F.col("p.id") == F.col("named"))
        apart = F.col("label") != F.col("p.label")
        near = fits(F.col("n"), F.col("place"), F.col("p.n"), F.col("p.place"), share)
        near &= alike(F.col("n"), F.col("sketch"), F.col("p.n"), F.col("marks"), share)
        met = state.join(pivots, "token").where(apart & near)
        met = stored(met.select("id", F.col("n"), F.col("p.drawn").alias("drawn"), F.col("p.id").alias("a")).distinct())
        # Sets too large for the short sketches are told apart by the wide ones.
        met = met.join(wide, "id").join(pivot_marks, F.col("a") == F.col("named"))
        met = met.where(alike_wide(F.col("n"), F.col("sketch"), F.col("size"), F.col("marks"), share))
        # Each set meets one pivot a round: the one drawn first, so that lists agree on it.
        pairs = met.groupBy("id").agg(F.min(F.struct("drawn", "a")).alias("p")).select(F.col("p.a").alias("a"), F.col("id").alias("b"))
        known = stored(distances(pairs, docs, firsts, share, size, stored))
        linked = linked.union(known.where("linked").select("a", "b"))
        labels = components(linked, path)
        latest = known.select(F.col("b").alias("id"), F.col("a").alias("pivot"), "distance")
        nearest = latest.union(nearest.join(latest.select("id"), "id", "left_anti"))
    state = lists.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    open_lists = state.groupBy("token").agg((F.min("label") != F.max("label")).alias("open")).where("open").select("token")
    mixed = with_earlier(state.drop("sketch").join(open_lists, "token")).join(nearest, "id", "left")
    mixed = stored(mixed.join(wide.hint("merge"), "id"))
    rest = stored(distances(mixed_pairs(mixed, share, limit), docs, firsts, share, size, stored))
    labels = components(linked.union(rest.where("linked").select("a", "b")), path)
    named = firsts.withColumnRenamed("first", "doc_id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_key = named.select("key", "label").join(smallest, "label").select("key", "component_id")
    own: Column = F.coalesce("component_id", "doc_id")
    return members.join(by_key, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
