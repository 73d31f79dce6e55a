"""Personal data by weak supervision, in SQL functions only.

Patterns propose spans. Three labelers vote on each: a strict form rule, a gazetteer
(top-level domains, country codes, card issuers) and the words before it. Expectation
maximisation over the counts of vote patterns, a table of at most 27 rows a kind,
estimates how reliable each labeler is; its posteriors train a logistic classifier of
spans. Base spans stay in any case; others stay if the classifier accepts them.

Defined cases: a null text is an empty one and has no spans; without any span
nothing is trained and the result has zero counts and empty lists.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, with guards that only keep a scan linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further candidates: forms without the base patterns' marks.
LOCAL_PHONE = r"(?<![0-9+()-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"

BASE = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
ADDED = (("local_phone", LOCAL_PHONE), ("national_id", NATIONAL_ID), ("iban", IBAN))
KINDS = tuple(kind for kind, _ in BASE + ADDED)
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Gazetteers and cue words, by kind.
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$",
    "ip": r"^(?!0|127|22[4-9]|2[3-5][0-9])",
    "card": r"^(?:4|5[1-5]|3[47]|6)",
    "phone": r"^\+(?:1|7|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-8])",
    "local_phone": r"^\(?[2-9]",
    "national_id": r"^(?!000|666|9)",
    "iban": r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
}
CUES = {
    "email": r"(?i)e-?mail|contact|write|address",
    "ip": r"(?i)\bip\b|server|host|client|from",
    "card": r"(?i)card|visa|credit|payment",
    "phone": r"(?i)phone|call|tel|mobile|fax|contact",
    "local_phone": r"(?i)phone|call|tel|mobile|fax|contact",
    "national_id": r"(?i)\bssn\b|social|security|insurance|\bid\b",
    "iban": r"(?i)iban|account|bank",
}
AGAINST = r"(?i)(?:version|order|page|isbn|issn|part|model|no\.|#)\W*$"
CUE_CHARS = 32
ROUNDS = 40
ACCEPT = 0.5

SPAN = "struct<start:int,end:int,kind:int,base:boolean,form:int,list:int,cue:int>"


def _luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(at, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _form(kind: str, hit: Column) -> Column:
    """Whether a match has the exact form of its kind."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        fits = F.length(digits).between(14, 19)
        return F.when(fits, _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return F.length(F.replace(hit, F.lit(" "), F.lit(""))).between(15, 34)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _spans(text: Column, no: int, kind: str, pattern: str, base: bool) -> Column:
    """All matches with their places: the parts between matches tell where they start."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")
    )
    start = F.struct(
        F.lit(0).alias("at"), F.lit("").alias("before"), F.array().cast(f"array<{SPAN}>").alias("out")
    )

    def step(acc: Column, part: Column) -> Column:
        hit, at = part["hit"], acc["at"] + F.length(part["gap"])
        before = F.right(F.concat(acc["before"], F.right(part["gap"], F.lit(CUE_CHARS))), F.lit(CUE_CHARS))
        form = _form(kind, hit)
        span = F.struct(
            at.alias("start"),
            (at + F.length(hit)).alias("end"),
            F.lit(no).alias("kind"),
            F.lit(base).alias("base"),
            F.when(form, 1).otherwise(-1).alias("form"),
            _vote(hit.rlike(GAZETTEER[kind]), F.lit(True)).alias("list"),
            _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)).alias("cue"),
        ).cast(SPAN)
        kept = hit.isNotNull() & form if base else hit.isNotNull()
        return F.struct(
            (at + F.coalesce(F.length(hit), F.lit(0))).alias("at"),
            before.alias("before"),
            F.when(kept, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"),
        )

    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(none)


def propose(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__spans``: every candidate and its votes, by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = [
        _spans(text, no, kind, pattern, no < len(BASE)) for no, (kind, pattern) in enumerate(BASE + ADDED)
    ]
    base = F.concat(*found[: len(BASE)])
    # What overlaps a base span is no further find.
    added = F.filter(
        F.concat(*found[len(BASE) :]),
        lambda x: ~F.exists(F.col("__base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    rows = docs.withColumn("__base", base)
    order = F.array_sort(F.concat(F.col("__base"), added))
    return rows.withColumn("__spans", _by_place(order)).drop("__base")


def _by_place(spans: Column) -> Column:
    """Spans by start, then kind."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("b"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def vote_counts(proposed: DataFrame) -> list[tuple[int, int, int, int, int]]:
    """(kind, form, list, cue, spans): at most 27 rows a kind, whatever the input."""
    counts = proposed.select(F.explode("__spans").alias("s")).select("s.*").groupBy("kind", "form", "list", "cue").count()
    return sorted(tuple(row) for row in counts.collect())


def reliabilities(counts: list[tuple[int, int, int, int, int]]) -> dict:
    """Posterior that a span is personal data, by vote pattern, from two latent classes."""
    prior = 0.7
    rate = {(lf, c, v): (0.7 if (v == 1) == (c == 1) else 0.15) for lf in range(3) for c in (0, 1) for v in (-1, 0, 1)}
    post: dict = {}
    for _ in range(ROUNDS):
        for kind, *votes, _ in counts:
            one = prior * math.prod(rate[lf, 1, v] for lf, v in enumerate(votes))
            two = (1 - prior) * math.prod(rate[lf, 0, v] for lf, v in enumerate(votes))
            post[(kind, *votes)] = one / (one + two)
        total = sum(n for *_, n in counts)
        yes = sum(n * post[tuple(key)] for *key, n in counts)
        prior = min(max((yes + 1) / (total + 2), 0.01), 0.99)
        for lf in range(3):
            for c in (0, 1):
                mass = {v: 1.0 for v in (-1, 0, 1)}
                for *key, n in counts:
                    p = post[tuple(key)]
                    mass[key[1 + lf]] += n * (p if c else 1 - p)
                whole = sum(mass.values())
                rate |= {(lf, c, v): mass[v] / whole for v in mass}
    return post


def train_classifier(counts: list[tuple[int, int, int, int, int]]) -> list[float]:
    """Logistic weights of kinds, then of each labeler's vote, from the posteriors."""
    post = reliabilities(counts)
    width = len(KINDS)
    weights = [0.0] * (width + 3)
    total = sum(n for *_, n in counts) or 1
    for _ in range(400):
        gradient = [0.001 * w for w in weights]
        for kind, *votes, n in counts:
            z = weights[kind] + sum(w * v for w, v in zip(weights[width:], votes, strict=True))
            miss = n / total * (1 / (1 + math.exp(-max(min(z, 30), -30))) - post[(kind, *votes)])
            gradient[kind] += miss
            for lf, v in enumerate(votes):
                gradient[width + lf] += miss * v
        weights = [w - g for w, g in zip(weights, gradient, strict=True)]
    return weights


def accepted(weights: list[float], spans: Column) -> Column:
    """Base spans, and those that the classifier takes."""
    kinds = F.array(*map(F.lit, weights[: len(KINDS)]))
    by_form, by_list, by_cue = weights[len(KINDS) :]
    level = math.log(ACCEPT / (1 - ACCEPT))

    def keep(s: Column) -> Column:
        z = F.get(kinds, s["kind"]) + by_form * s["form"] + by_list * s["list"] + by_cue * s["cue"]
        return s["base"] | (z >= level)

    return F.filter(spans, keep)


def labelled_rows(proposed: DataFrame, stored: str) -> DataFrame:
    """``proposed`` with the final ``__spans``. Candidates are found once and stored."""
    proposed.write.parquet(stored)
    rows = proposed.sparkSession.read.parquet(stored)
    weights = train_classifier(vote_counts(rows))
    return rows.withColumn("__spans", accepted(weights, F.col("__spans")))


def listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.get(names, s["kind"]))).alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], new).otherwise(longer)

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))
