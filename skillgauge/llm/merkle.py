"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces.

Blank lines part sections, line ends paragraphs, and a paragraph is cut into pieces
where its own letters say so, so an edit changes only the pieces it touches. A
paragraph's digest is made from those of its pieces, a section's from those of its
paragraphs, and the root from those of the sections. The fingerprint holds the root
in full and every node below it in short. Equal roots mean equal texts; otherwise
only branches whose digests differ are entered, down to the edited pieces.

Defined cases: a null text is an empty one; rows of one doc_id are ordered by a hash
of their text, then by the text; a null doc_id comes first; the only row of a table is
its own next one.
"""

from __future__ import annotations

import hashlib
import re
from base64 import urlsafe_b64encode
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE = re.compile(r".{40,160}?(?:(?<=[a-e.,])\s|\Z)|.{1,160}", re.S)
# Characters that a node keeps of its digest.
PIECE_CHARS, PARAGRAPH_CHARS, SECTION_CHARS = 4, 8, 12

Paragraph = tuple[str, list[str]]
Section = tuple[str, list[Paragraph]]


def _digest(data: bytes, level: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=32, person=level).digest()


def _short(digest: bytes, chars: int) -> str:
    return urlsafe_b64encode(digest[: chars * 3 // 4]).decode()


def fingerprint(text: str) -> str:
    """``root|section;section``: a section is its digest and ``paragraph,paragraph``, a
    paragraph is its digest and those of its pieces. One piece stands for its
    paragraph; an empty paragraph is empty."""
    sections, tops = [], []
    for part in text.split("\n\n"):
        paragraphs, middles = [], []
        for line in part.split("\n"):
            leaves = [_digest(piece.encode(), b"piece") for piece in PIECE.findall(line)]
            middle = _digest(b"".join(leaves), b"paragraph")
            middles.append(middle)
            own = _short(middle, PARAGRAPH_CHARS) if len(leaves) > 1 else ""
            paragraphs.append(own + "".join([_short(leaf, PIECE_CHARS) for leaf in leaves]))
        top = _digest(b"".join(middles), b"section")
        tops.append(top)
        sections.append(_short(top, SECTION_CHARS) + ",".join(paragraphs))
    return f"{_digest(b''.join(tops), b'root').hex()}|{';'.join(sections)}"


def tree(mark: str) -> tuple[str, list[Section]]:
    """The root, and each section with its paragraphs with their pieces."""

    def paragraph(node: str) -> Paragraph:
        pieces = node[PARAGRAPH_CHARS:] if len(node) > PIECE_CHARS else node
        return node, [pieces[i : i + PIECE_CHARS] for i in range(0, len(pieces), PIECE_CHARS)]

    root, _, body = mark.partition("|")
    return root, [
        (node[:SECTION_CHARS], [paragraph(p) for p in node[SECTION_CHARS:].split(",")]) for node in body.split(";")
    ]


def _unlike(ours: list, theirs: list) -> tuple[list, list]:
    """The branches, ``(digest, ...)``, that have no equal partner on the other side."""
    here, there = Counter(n[0] for n in ours), Counter(n[0] for n in theirs)

    def left(nodes: list, partners: Counter) -> list:
        out = []
        for node in nodes:
            if partners[node[0]] > 0:
                partners[node[0]] -= 1
            else:
                out.append(node)
        return out

    return left(ours, there), left(theirs, here)


def differing(one: str, other: str) -> tuple[list[tuple], list[tuple]]:
    """Pieces of either fingerprint without an equal partner, as (digest, section,
    paragraph, piece); only sections and paragraphs that differ are entered."""
    if one[:64] == other[:64]:
        return [], []
    sides = [[(d, i, lines) for i, (d, lines) in enumerate(tree(mark)[1])] for mark in (one, other)]
    sides = _unlike(*sides)
    sides = [[(d, i, j, leaves) for _, i, lines in side for j, (d, leaves) in enumerate(lines)] for side in sides]
    sides = _unlike(*sides)
    sides = [[(d, i, j, k) for _, i, j, leaves in side for k, d in enumerate(leaves)] for side in sides]
    return _unlike(*sides)


def n_pieces(mark: str) -> int:
    return sum(len(leaves) for _, lines in tree(mark)[1] for _, leaves in lines)


def likeness(one: str, other: str) -> float:
    """Share of pieces that two fingerprints have in common (0 to 1)."""
    if one[:64] == other[:64]:
        return 1.0
    size = n_pieces(one) + n_pieces(other)
    return 1 - sum(map(len, differing(one, other))) / size if size else 0.0


def edits(one: str, other: str) -> list[tuple[int, int, int, int]]:
    """Places of ``other`` that ``one`` has not: (section, paragraph, first piece, end)."""
    found: list[tuple[int, int, int, int]] = []
    for _, section, paragraph, piece in differing(one, other)[1]:
        if found and found[-1][:2] == (section, paragraph) and found[-1][3] == piece:
            found[-1] = (*found[-1][:3], piece + 1)
        else:
            found.append((section, paragraph, piece, piece + 1))
    return found


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by the start of the next text."""
    size = len(text) // 4
    return text[: len(text) - size] + after[:size]


FIELDS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
    "n_edits": pa.int64(), "first_edit": pa.string(), "last_edit": pa.string(),
}
ENDS = {"part": pa.int32(), "head": pa.string(), "tail": pa.string()}
ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_edits long, first_edit string, last_edit string"


def compared(doc_id, text: str, mark: str, after: str, after_mark: str) -> list:
    new = edited(text, after)
    new_mark = fingerprint(new)
    digest = hashlib.sha256(new.encode()).hexdigest()
    near = likeness(mark, new_mark), likeness(mark, after_mark)
    places = [f"{i}.{j}.{first}-{end}" for i, j, first, end in edits(mark, new_mark)]
    ends = (places[0], places[-1]) if places else (None, None)
    return [doc_id, len(text), digest, mark, new_mark, *near, len(places), *ends]


def _table(rows: list[list], fields: dict) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, fields.values(), strict=True)], list(fields)
    )


def fingerprints(docs: DataFrame, stored: str) -> DataFrame:
    """Fingerprints of each text, of its edited text, their likenesses, and where the
    edited text's tree differs: ``n_edits`` places, the first and the last of them as
    ``section.paragraph.first_piece-end_piece``, counted from 0.

    Texts are dealt into ranges of doc_id once. A range knows the next text of all
    its rows but the last; those rows, one a range, are joined with the first row of
    the range that follows. ``stored`` keeps the results of the first step.
    """

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, head = None, None
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = []
                some = batch.slice(first, 256)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    mark = fingerprint(text)
                    if before is None:
                        head = text
                    else:
                        rows.append([*compared(*before, text, mark), part, head, None])
                        head = None
                    before = (doc_id, text, mark)
                yield _table(rows, FIELDS | ENDS)
        if before is not None:
            doc_id, text, _ = before
            yield _table([[doc_id, *[None] * (len(FIELDS) - 1), part, head, text]], FIELDS | ENDS)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                compared(doc_id, text, fingerprint(text), after, fingerprint(after))
                for doc_id, text, after in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            yield _table(rows, FIELDS)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    keyed.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(
        ranged, f"{ROW}, part int, head string, tail string"
    ).write.option("compression", "zstd").parquet(stored)
    rows = docs.sparkSession.read.parquet(stored)
    heads = rows.where("head IS NOT NULL").select(F.col("part").alias("next"), "head")
    # One narrow row a range; its number is that of the ranges, not of the rows.
    places = rows.where("tail IS NOT NULL").select("part")
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(in_order))
    places = places.select("part", after.alias("next"))
    tails = rows.where("tail IS NOT NULL").select("part", "doc_id", "tail")
    last = tails.join(places, "part").join(heads, "next").select("doc_id", "tail", "head").mapInArrow(ends, ROW)
    return rows.where("tail IS NULL").select(*FIELDS).unionByName(last)
