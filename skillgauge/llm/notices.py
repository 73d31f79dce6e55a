"""License scan: exact phrases, and short notices with a bounded number of errors.

A notice may differ in k letters. Split into k + 1 parts, one of them must then occur
unchanged: an automaton finds the parts, and around each the regex library's
bounded-error matching decides and counts the errors. Words are compared in lower
case with one space between them, so layout and punctuation do not count.

Defined cases: a null text is an empty one; no label gives an empty string and the
score 0.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ERROR_EVERY = 12

# Phrases of the base labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Short notices and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license version", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license version 2 0", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("all rights reserved", "proprietary"),
)


@lru_cache(maxsize=4)
def scanner(notices: tuple[tuple[str, str], ...]):
    """Automaton of all parts, and each notice's pattern, length and errors."""
    seeds = ahocorasick.Automaton()
    held: dict[str, list[tuple[int, int]]] = {}
    checks = []
    for no, (notice, _) in enumerate(notices):
        errors = len(notice) // ERROR_EVERY
        checks.append((regex.compile(f"(?b)(?<![^ ])(?:{regex.escape(notice, special_only=True)}){{e<={errors}}}(?![^ ])"), len(notice), errors))
        step, over = divmod(len(notice), errors + 1)
        at = 0
        for part in range(errors + 1):
            size = step + (part < over)
            held.setdefault(notice[at : at + size], []).append((no, at))
            at += size
    for seed, places in held.items():
        seeds.add_word(seed, (len(seed), places))
    seeds.make_automaton()
    return seeds, checks


def fuzzy_spans(joined: str, notices=NOTICES) -> list[tuple[int, int, str, int, float]]:
    """(start, end, label, errors, likeness) of notices in the joined words.

    Hits of one notice do not overlap; of those that do the one with fewer errors
    counts, then the earlier. What a hit leaves free of its window is searched again.
    Windows have a fixed length, so work grows with the number of seeds.
    """
    seeds, checks = scanner(notices)
    windows: list[set[int]] = [set() for _ in notices]
    for end, (size, places) in seeds.iter(joined):
        for no, offset in places:
            # One character more than the match may reach shows whether a word ends there.
            windows[no].add(max(end + 1 - size - offset - checks[no][2] - 1, 0))
    found = []
    for no, firsts in enumerate(windows):
        pattern, length, errors = checks[no]
        kept: list[tuple[int, int, int]] = []
        wanted = [(first, min(first + length + 3 * errors + 2, len(joined))) for first in sorted(firsts)]
        while wanted:
            hits = []
            for first, last in wanted:
                if hit := pattern.search(joined, first, last) if first < last else None:
                    hits.append((sum(hit.fuzzy_counts), hit.start(), hit.end(), first, last))
            taken = len(kept)
            for wrong, start, end, _, _ in sorted(hits):
                at = bisect_left(kept, (start, end, 0))
                after = kept[at][0] if at < len(kept) else len(joined) + 1
                if (not at or kept[at - 1][1] < start) and end < after:
                    kept.insert(at, (start, end, wrong))
            if taken == len(kept):
                break
            free = {gap for *_, first, last in hits for gap in _gaps(kept, first, last)}
            wanted = sorted(gap for gap in free if gap[1] - gap[0] >= length - errors)
        found += [(a, b, notices[no][1], wrong, 1 - wrong / length) for a, b, wrong in kept]
    return sorted(set(found))


def _gaps(kept: list[tuple[int, int, int]], first: int, last: int) -> Iterator[tuple[int, int]]:
    """The parts of a window that no hit covers, without the space beside a hit."""
    at = max(bisect_left(kept, (first, 0, 0)) - 1, 0)
    while at < len(kept) and kept[at][0] < last:
        start, end, _ = kept[at]
        if end > first:
            if start > first:
                yield first, start - 1
            first = end
        at += 1
    yield first, last


def _word_numbers(joined: str, places: set[int]) -> dict[int, int]:
    """The number of the word at each place, counting once over the text."""
    numbers, counted, no = {}, 0, 0
    for place in sorted(places):
        no += joined.count(" ", counted, place)
        counted = place
        numbers[place] = no
    return numbers


def scan(text: str, notices=NOTICES) -> dict:
    words = WORD.findall(text.translate(LOWER))
    joined = " ".join(words)
    ringed = f" {joined} "
    places, base = [], set()
    for phrase, label in PHRASES:
        at, counted, no = ringed.find(f" {phrase} "), 0, 0
        while at >= 0:
            no += ringed.count(" ", counted, at)
            counted = at
            places.append(no)
            base.add(label)
            at = ringed.find(f" {phrase} ", at + 1)
    spans = fuzzy_spans(joined, notices)
    labels = base | {label for _, _, label, _, _ in spans}
    ordinal = _word_numbers(joined, {place for a, b, *_ in spans for place in (a, b)})
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": 1.0 if base else max((likeness for *_, likeness in spans), default=0.0),
        "spans": [
            {"first_word": ordinal[a], "end_word": ordinal[b] + 1, "label": label, "errors": e}
            for a, b, label, e, _ in spans
        ],
    }


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<first_word:long,end_word:long,label:string,errors:int>>"
)
SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("errors", pa.int32())])
FIELDS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(SPAN),
}


def scan_licenses(docs: DataFrame, notices=NOTICES) -> DataFrame:
    """Labels, word places and fuzzy spans of each whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py() or "", notices) for t in batch.column(1)]
            arrays = [pa.array([f[k] for f in found], kind) for k, kind in FIELDS.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *FIELDS])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(rows, SCHEMA)
