"""SentencePiece encoding by a table of each prefix's last token.

Merges of a merge-type vocabulary depend only on neighbours, so a text's encoding is
the one sequence in which each token follows a compatible one: encoding just the two
together gives the two. Going over a text once, an automaton lists the pieces that
end at each place; the one compatible with the last token of the prefix before it is
that prefix's last token. Walking back from the end recovers the ids. Characters
that are no piece stand alone and become their bytes.

No piece crosses from another character into a space mark, or holds a line end, so
texts are cut there, and ids of short chunks are kept in a bounded table.

Defined cases: a null text is an empty one; an empty text has no ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CHUNK = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
KEPT_CHUNKS = 300_000
KEPT_CHARS = 48
KEPT_PAIRS = 1_000_000
BATCH_TEXTS = 64


class PrefixEncoder:
    """Encodes texts as the library does, for a merge-type model with byte fallback."""

    def __init__(self, model: str) -> None:
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ids, self.scores, self.names = {}, {}, {}
        for i in range(sp.vocab_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                piece = sp.id_to_piece(i)
                self.ids[piece], self.scores[piece] = i, sp.get_score(i)
        # A fixed sample that every known normaliser but identity changes.
        sample = "ﬁ Ａ²  ｶﾞ\t\n x "
        if sp.normalize(sample).replace(MARK, " ") != f" {sample}":
            raise ValueError("the model's normaliser changes texts")
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces cross the cuts of this encoder")
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Each piece with the tokens tried before it: whether both stay as they are.
        self.automaton = ahocorasick.Automaton()
        self.tried: list[dict[str, bool]] = []
        self.n_tried = 0
        for piece in self.ids:
            if self.merged(piece) == [piece]:
                self.tried.append({})
                self.automaton.add_word(piece, (piece, len(piece), self.tried[-1]))
        self.automaton.make_automaton()
        self.chunks: dict[str, tuple[list[int], str]] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short string, merging the best pair first, the leftmost of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str, tried: dict[str, bool]) -> bool:
        if self.n_tried >= KEPT_PAIRS:
            for table in self.tried:
                table.clear()
            self.n_tried = 0
        self.n_tried += 1
        known = tried[left] = self.merged(left + right) == [left, right]
        return known

    def tokens(self, text: str) -> list[str]:
        ids = self.ids
        last: list[str] = [""] * (len(text) + 1)
        # Ends ascend, so what ends before a piece is settled when the piece is met.
        for end, (piece, size, tried) in self.automaton.iter(text):
            if last[end + 1]:
                continue
            start = end + 1 - size
            if start:
                before = last[start]
                if not before:
                    if text[start - 1] in ids:
                        continue
                    before = last[start] = text[start - 1]
                known = tried.get(before)
                if known is None:
                    known = self.compatible(before, piece, tried)
                if not known:
                    continue
            last[end + 1] = piece
        out, at = [], len(text)
        while at:
            token = last[at] or text[at - 1]
            out.append(token)
            at -= len(token)
        out.reverse()
        return out

    def chunk_ids(self, chunk: str) -> tuple[list[int], str]:
        known = self.chunks.get(chunk)
        if known is None:
            ids: list[int] = []
            for token in self.tokens(chunk):
                if token in self.ids:
                    ids.append(self.ids[token])
                else:
                    ids.extend(self.byte_ids[b] for b in token.encode())
            known = (ids, ",".join(map(str, ids)))
            if len(chunk) <= KEPT_CHARS:
                if len(self.chunks) >= KEPT_CHUNKS:
                    self.chunks.clear()
                self.chunks[chunk] = known
        return known

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids, and the same joined by commas."""
        if not text:
            return [], ""
        known = self.chunks.get
        coded = [known(c) or self.chunk_ids(c) for c in CHUNK.findall(MARK + text.replace(" ", MARK))]
        return list(chain.from_iterable(map(itemgetter(0), coded))), ",".join(map(itemgetter(1), coded))


@lru_cache(maxsize=1)
def encoder(model: str) -> PrefixEncoder:
    return PrefixEncoder(model)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


OUTPUTS = {
    "n_tokens": ("long", pa.int64(), lambda ids, name, decoded: len(ids)),
    "ids": ("array<int>", pa.list_(pa.int32()), lambda ids, name, decoded: ids),
    "ids_sha256": ("string", pa.string(), lambda ids, name, decoded: sha256(name)),
    "decoded": ("string", pa.string(), lambda ids, name, decoded: decoded),
    "decoded_sha256": ("string", pa.string(), lambda ids, name, decoded: sha256(decoded)),
}


def encode_texts(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", outputs: tuple[str, ...] = tuple(OUTPUTS)
) -> DataFrame:
    """``doc_id`` and the ``outputs`` asked for of each row's whole text.

    ``model`` is a path that every executor can open. Columns left out are not built:
    Spark cannot take them out of a Python step by itself.
    """
    kinds = [OUTPUTS[name] for name in outputs]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        decode = coder.library.decode
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(first, BATCH_TEXTS)
                coded = [coder.encode(t or "") for t in part.column(1).to_pylist()]
                whole = [(ids, name, decode(ids) if ids else "") for ids, name in coded]
                arrays = [pa.array([make(*row) for row in whole], kind) for _, kind, make in kinds]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["doc_id", *outputs])

    schema = ", ".join(["doc_id long", *(f"{name} {OUTPUTS[name][0]}" for name in outputs)])
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(rows, schema)
