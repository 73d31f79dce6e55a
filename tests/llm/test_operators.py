"""The queries against plain versions on whole small tables and on odd rows."""

import hashlib
import random
import re
import timeit
from collections import Counter

import pytest

pytest.importorskip("skillgauge.llm")

import public_tokenizers  # noqa: E402
import sentencepiece  # noqa: E402

from skillgauge.llm import merkle, queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, None, "en", None, 0),
    (2, "", "en", "b", 0),
    (3, "a@b.co_d@e.fr 1.2.3.4.5.6.7.8 300.1.1.1 +1 (755) 555-9729 4111 1111 1111 1111 é 0001.2.3.255", "en", "b", 9),
    (4, "MIT License, mit license; Apache-license GENERAL public license", "en", "a", 9),
    (5, "x" * 5000 + " 1" * 3000 + "+" * 50, "en", "b", 9),
    (6, "one two three four five six\n\n\nseven  eight\tnine ▁ \x00 日本😀", "en", "b", 9),
    (6, "one two three four five six\n\n\nseven  eight\tnine ▁ \x00 日本😀", "en", "b", 9),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module", params=["small", "odd", "empty"])
def folder(request, spark, tmp_path_factory):
    if request.param == "small":
        return SMALL
    path = str(tmp_path_factory.mktemp(request.param))
    rows = ODD if request.param == "odd" else []
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def given(spark, folder):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def test_encoding(spark, folder):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for doc_id, text in given(spark, folder):
        ids = sp.encode(text)
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids) if ids else "")))
    assert sorted(map(tuple, queries.op3_sentencepiece(spark, folder).collect())) == sorted(want)


def test_quality(spark, folder):
    rows = queries.op2_quality_ranking(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in given(spark, folder))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op2_quality_ranking(spark, folder).collect()
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.9 * len(held)


def test_licenses(spark, folder):
    def plain(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        found = []
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            parts = phrase.split()
            found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places = [i for i, _ in found]
        return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))

    want = sorted((d, *plain(t)) for d, t in given(spark, folder))
    rows = queries.op4_license_scan(spark, folder).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == want
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_private_data(spark, folder):
    rows = queries.op6_private_data(spark, folder).collect()
    want = sorted((d, *(sum(s.startswith(k) for s in f) for k in ("email", "ip", "card", "phone")), sha(",".join(f))) for d, t in given(spark, folder) for f in [plain_spans(t)])
    assert sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want


def test_fingerprints(spark, folder):
    docs = sorted(given(spark, folder))
    want = []
    for i, (doc_id, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        want.append((doc_id, len(text), sha(text[: len(text) - len(text) // 4] + after[: len(text) // 4])))
    rows = queries.op8_merkle(spark, folder).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    assert {r.doc_id: r.fingerprint for r in rows} == {d: merkle.fingerprint(t) for d, t in docs}
    near = {d: [0.0, 0.0] for d, _ in docs}
    for i, (doc_id, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        near[doc_id] = [plain_likeness(text, merkle.edited(text, after)), plain_likeness(text, after)]
    if len(near) == len(docs):
        for r in rows:
            assert [r.near_edited, r.near_next] == pytest.approx(near[r.doc_id], abs=1e-9)
    for r in rows:
        assert r.edited_fingerprint == r.fingerprint or r.n_edits or r.near_edited < 1
    long = [r for r in rows if r.n_chars > 500]
    if folder == SMALL:
        assert sum(r.near_edited > 0.5 for r in long) > 0.95 * len(long)


def plain_likeness(a, b):
    """Share of equal pieces, without a tree."""
    if a == b:
        return 1.0
    one, two = (Counter(p for line in t.split("\n") for p in merkle.PIECE.findall(line)) for t in (a, b))
    size = one.total() + two.total()
    return 2 * (one & two).total() / size if size else 0.0


def test_edits_are_located():
    one = merkle.fingerprint("first line\nsecond line\n\nthird line")
    two = merkle.fingerprint("first line\nsecond line, changed\n\nthird line")
    assert merkle.edits(one, two) == [(0, 1, 0, 1)] and merkle.edits(one, one) == []
    line = " ".join(f"word{i}e and more." for i in range(60))
    pieces = merkle.PIECE.findall(line)
    assert "".join(pieces) == line and len(pieces) > 4
    changed = line.replace(pieces[2], pieces[2].replace("and", "AND"))
    places = merkle.edits(*map(merkle.fingerprint, (f"a\n\nb\n{line}", f"a\n\nb\n{changed}")))
    assert places == [(1, 1, 2, 3)]


def test_roots_tell_texts_apart():
    texts = ["", "\n", "\n\n", "\n\n\n", "a", "a\n", "\na", "a\n\n", "a\nb", "a\n\nb", "ab", "a" * 300, "a" * 301]
    marks = [merkle.fingerprint(t) for t in texts]
    assert len({m[:64] for m in marks}) == len(texts)
    assert all(merkle.likeness(m, m) == 1 and merkle.edits(m, m) == [] for m in marks)


def test_tree_digests_follow_from_those_below():
    root, sections = merkle.tree(merkle.fingerprint("one\ntwo\n\n" + "x" * 600))
    assert [len(lines) for _, lines in sections] == [2, 1]
    assert [len(leaves) for _, lines in sections for _, leaves in lines] == [1, 1, 4]
    assert sections[0][0] != sections[1][0] and len(root) == 64


def test_notice_spans():
    from skillgauge.llm import notices

    def spans(text):
        return [(s["first_word"], s["end_word"], s["label"], s["errors"]) for s in notices.scan(text)["spans"]]

    assert spans("all right reserved all rights reserved") == [(0, 3, "proprietary", 1), (3, 6, "proprietary", 0)]
    assert spans("x All RIGHTS\n reserved, y") == [(1, 4, "proprietary", 0)]
    assert spans("the small rights reserved") == [] and spans("") == []
    many = spans("foo all rihts reserved " * 500)
    assert many == [(4 * i + 1, 4 * i + 4, "proprietary", 1) for i in range(500)]


def test_notices_of_long_texts():
    from skillgauge.llm import notices

    def seconds(times):
        text = "all right reserved foo " * times
        return min(timeit.repeat(lambda: notices.scan(text), number=1, repeat=3))

    assert seconds(8000) < 3 * seconds(4000)


def test_license_query_lists_spans(spark, folder):
    for r in queries.op4_license_scan(spark, folder).collect():
        labels = {s.split(":")[0] for s in r.spans.split(",") if s}
        assert labels <= set(r.labels.split(",")) and labels | set(r.base_labels.split(",")) >= set(r.labels.split(","))


def test_mix_with_clashing_columns(spark, tmp_path):
    from pyspark.sql import functions as F

    from skillgauge.llm import mixing

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = ("size", "key", "epochs", "part", "at", "target", "source_size", "cut_key")
    wide = docs.select("*", *[F.lit(777).alias(n) for n in names])
    plain = mixing.apply_mix(docs, mixing.MixRule(), str(tmp_path / "a"))
    mixed = mixing.apply_mix(wide, mixing.MixRule(), str(tmp_path / "b"))
    assert mixed.columns == wide.columns
    assert mixed.select([F.min(n) for n in names] + [F.max(n) for n in names]).first() == (777,) * 16
    assert mixed.select(docs.columns).exceptAll(plain).isEmpty() and mixed.count() == plain.count()
    with pytest.raises(ValueError):
        mixing.apply_mix(docs.withColumn("__mix_size", F.lit(1)), mixing.MixRule(), str(tmp_path / "c"))


def test_encoder_outputs(spark):
    from skillgauge.llm import pieces

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "ab  cd ▁e日😀\x00"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pieces.encode_texts(docs, model).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = sp.encode("ab  cd ▁e日😀\x00")
    assert rows[1].ids == ids and rows[1].decoded == sp.decode(ids) and rows[1].n_tokens == len(ids)
    assert rows[2].ids == [] and rows[2].decoded == ""
    assert pieces.encode_texts(docs, model, outputs=("ids",)).columns == ["doc_id", "ids"]


def test_components(spark, folder):
    import numpy as np

    from skillgauge.llm import jaccard

    docs = given(spark, folder)
    sets = [(d, set(jaccard.shingles(t).tolist())) for d, t in docs]
    label = {d: d for d, _ in docs}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    want = sorted((d, len(x), label[d]) for d, x in sets)
    assert sorted(map(tuple, queries.op5_ngram_jaccard(spark, folder).collect())) == want
    assert len(np.unique([c for *_, c in want])) <= max(len(want), 1)


@pytest.mark.parametrize(("rounds", "limit"), [(0, 2), (1, 3)])
def test_components_by_blocks(spark, tmp_path, rounds, limit):
    from skillgauge.llm import jaccard

    pick = random.Random(7)
    docs = []
    for group in range(12):
        base = [f"w{group % 5}x{k}" for k in range(40 + 9 * group)]
        for _ in range(8):
            words = list(base)
            for _ in range(pick.choice([0, 1, 2, 3, 5])):
                words[pick.randrange(len(words))] = f"e{pick.randrange(30)}"
            docs.append((len(docs) * 3 - 40, " ".join(words[: pick.randrange(20, len(words) + 1)])))
    docs += [(docs[3][0], docs[9][1]), docs[5], (None, docs[7][1]), (900, None), (901, ""), (902, "a b"), (903, "A  b")]
    sets = [(d, frozenset(jaccard.shingles(t).tolist())) for d, t in docs if d is not None]
    # Rows of one id are one node.
    label = {d: d for d, _ in sets}
    sizes = [(a, b) for a, x in sets for b, y in sets if x and y and a != b and 5 * len(x & y) >= 4 * len(x | y)]
    for _ in label:
        for a, b in sizes:
            label[a] = label[b] = min(label[a], label[b])
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard.linked_components(table, lambda: f"{tmp_path}/{random.random()}", rounds=rounds, limit=limit)
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in found.collect() if r.doc_id is not None]
    assert len({c for _, _, c in rows}) > 12
    several = {docs[3][0]}
    assert sorted(r for r in rows if r[0] not in several) == sorted((d, len(x), label[d]) for d, x in sets if d not in several)


def test_sketches_never_differ_more_than_sets():
    import numpy as np

    from skillgauge.llm import jaccard

    pick = random.Random(3)
    for _ in range(50):
        x, y = (np.unique(np.array([pick.randrange(2**64) for _ in range(pick.randrange(1, 400))], np.uint64)) for _ in "xy")
        y = np.unique(np.concatenate([y, x[: pick.randrange(len(x) + 1)]]))
        bits = np.bitwise_count(jaccard.sketch(x).view(np.uint64) ^ jaccard.sketch(y).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(x, y))


def test_pipeline(spark, folder):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in rows}
    groups = {r.doc_id: r.component_id for r in queries.op5_ngram_jaccard(spark, folder).collect()}
    good = {r.doc_id for r in queries.op2_quality_ranking(spark, folder).collect() if r.predicted}
    assert kept <= good
    if folder == SMALL:
        # Each group of documents that are all good leaves one.
        assert {groups[d] for d in kept} <= {groups[d] for d in good} and len(kept) > len({groups[d] for d in good}) / 2


def test_mixing(spark, folder):
    import math
    from collections import defaultdict

    rows = queries.op9_mixing(spark, folder).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes = sorted((d, len(re.findall(r"[^\x20\x09-\x0D]+", t))) for d, t in given(spark, folder))
    assert sorted((r.doc_id, r.size) for r in rows) == sizes
    whole, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        whole[source[r.doc_id]] += r.size
        target[source[r.doc_id]] = r.target
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size is not None
    names = sorted(whole, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, [3, 1, 2] * len(names), strict=False))
    left, free, want = 1.5 * sum(whole.values()), list(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 2 * whole[s]]
        if not over:
            want |= {s: weight[s] * level for s in free}
            break
        want |= {s: 2.0 * whole[s] for s in over}
        left -= sum(2.0 * whole[s] for s in over)
        free = [s for s in free if s not in over]
    for s in names:
        assert math.isclose(target[s], want[s], rel_tol=1e-9, abs_tol=1e-6)
        # Rows of one id cut at the budget may each lose part of a word.
        assert abs(taken[s] - target[s]) <= 3
    assert sorted(map(tuple, queries.op9_mixing(spark, folder).collect())) == sorted(map(tuple, rows))


def test_repeated_windows(spark, folder):
    docs = sorted(given(spark, folder))
    seen, want = {}, []
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in docs]
    for d, words in split:
        for i in range(len(words) - 19):
            key = tuple(words[i : i + 20])
            seen[key] = min(seen.get(key, (d, i)), (d, i))
    for d, words in split:
        gone = set()
        for i in range(len(words) - 19):
            if seen[tuple(words[i : i + 20])] < (d, i):
                gone.update(range(i, i + 20))
        want.append((d, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    rows = sorted(map(tuple, queries.op7_substring_dedup(spark, folder).collect()))
    assert rows == sorted(want)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_notice_spans_leave_no_hit_in_the_gaps():
    from skillgauge.llm.notices import fuzzy_spans

    notice = "all rights reserved"
    joined = "all right reserved all rights reserved"
    assert [s[:2] for s in fuzzy_spans(joined, ((notice, "x"),))] == [(0, 18), (19, 38)]

    rng = random.Random(5)
    words = ["all", "rights", "right", "reserved", "reservd", "al", "of"]
    many = 0
    for _ in range(300):
        joined = " ".join(rng.choice([notice, "all right reserved", "all rights reservd", *words]) for _ in range(8))
        spans = fuzzy_spans(joined, ((notice, "x"),))
        assert all(edits(joined[a:b], notice) <= errors <= 1 for a, b, _, errors, _ in spans)
        many += len(spans) > 1
        at = 0
        for a, b in [*(s[:2] for s in spans), (len(joined) + 1, 0)]:
            gap = joined[at : max(a - 1, at)].split()
            parts = (" ".join(gap[i:j]) for i in range(len(gap)) for j in range(i + 1, min(i + 5, len(gap)) + 1))
            assert not [part for part in parts if edits(part, notice) <= 1]
            at = b
    assert many > 100


def test_repeated_grams_shuffles_once_and_leaves_out_single_ones(spark):
    from skillgauge.llm import repeats

    grams = [1] * 3 + [2] + [3] * 25 + list(range(10, 60))
    found = spark.createDataFrame([(i, g) for i, g in enumerate(grams)], "start long, gram long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        kept = repeats.repeated_grams(found)
        assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert sorted(map(tuple, kept.collect())) == [(i, g) for i, g in enumerate(grams) if g in (1, 3)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_op7_stores_no_segment_whose_gram_occurs_once(spark, tmp_path):
    from skillgauge.llm import repeats

    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(200)) + (f" {shared}" if i < 2 else "")) for i in range(6)]
    paths = []

    def path():
        paths.append(str(tmp_path / f"step{len(paths)}"))
        return paths[-1]

    kept = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), path)
    assert {r.doc_id: r.n_removed for r in kept.collect()} == {i: 30 * (i == 1) for i in range(6)}
    first = spark.read.parquet(paths[0])
    assert first.count() > 0 and not first.groupBy("gram").count().where("count = 1").count()


def test_op7_segments_have_equal_digests_only_if_their_words_are_equal():
    from skillgauge.llm import repeats

    drawn = random.Random(3)
    words = [b"%d" % drawn.randrange(3) for _ in range(4000)]
    starts, sizes, grams, digests = repeats.segments(words, repeats.WordHashes())
    assert sizes.max() <= repeats.LONGEST and int(sizes.sum()) == len(words) - 19 + 19 * len(sizes)
    named = {}
    for at, n, gram, digest in zip(starts, sizes, grams, digests, strict=True):
        named.setdefault((gram, digest), set()).add(tuple(words[at : at + n]))
    assert all(len(held) == 1 for held in named.values())
    assert len(set(map(next, map(iter, named.values())))) == len(named)


def test_op5_wide_sketches_tell_large_sets_apart_and_lose_no_pair(spark):
    import numpy as np
    from skillgauge.llm import jaccard

    drawn = np.random.default_rng(2)
    base = drawn.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [np.unique(np.r_[base[:20], drawn.integers(0, 2**63, 2600 + 40 * k, dtype=np.uint64)]) for k in range(12)]
    # Near copies of sizes with sketches of different widths.
    sets += [np.unique(base[:2000]), np.unique(base[:2200])]
    rows = [
        (7, bytes([k]), len(x), 0, bytes([k]), None, None, [int(w) for w in jaccard.sketch(x, jaccard.sketch_words(len(x)))])
        for k, x in enumerate(sets)
    ]
    schema = "token long, id binary, n long, place int, label binary, pivot binary, distance double, sketch array<long>"
    assert len({len(r[-1]) for r in rows}) > 1
    found = jaccard.mixed_pairs(spark.createDataFrame(rows, schema), jaccard.SHARE)
    assert [(bytes(r.a), bytes(r.b)) for r in found.collect()] == [(bytes([12]), bytes([13]))]
    both = jaccard.sketch(sets[0], 32)[None, :].view(np.uint64)
    assert (jaccard.narrowed(both, 8)[0] == jaccard.sketch(sets[0]).view(np.uint64)).all()


def test_op5_shingles_of_odd_words_are_told_apart():
    from skillgauge.llm import jaccard

    pick = random.Random(11)
    parts = ["a", "B", "É", " ", "\n", "\x0b", "zz", "long" * 20, "\x00", "abcdefgh"]
    for _ in range(200):
        texts = ["".join(pick.choice(parts) for _ in range(pick.randrange(30))) for _ in range(4)]
        for text, found in zip(texts, jaccard.shingle_rows([t.encode() for t in texts]), strict=True):
            words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
            size = min(5, len(words))
            want = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()
            assert len(set(found.tolist())) == len(want)
            assert sorted(set(found.tolist())) == jaccard.shingles(text).tolist()


def test_op5_entries_without_a_partner_of_a_fitting_size_are_left_out(spark):
    from skillgauge.llm import jaccard

    sizes = {"a": 100, "b": 121, "c": 200, "d": 250, "e": 313}
    rows = [(1, name.encode(), n, 0) for name, n in sizes.items()]
    entries = spark.createDataFrame([*rows, (2, b"a", 100, 1)], "token long, id binary, n long, place int")
    kept = jaccard.shared_entries(entries, jaccard.SHARE).collect()
    assert sorted((r.token, bytes(r.id)) for r in kept) == [(1, b"a"), (1, b"b"), (1, b"c"), (1, b"d")]
    # With two spare entries a set needs three, and keeps all but two.
    assert jaccard.spare_length(100, jaccard.SHARE) == 8 and jaccard.spare_length(80, jaccard.SHARE) == 6
    held = [(t, b"x", 100, t) for t in range(9)] + [(t, b"y", 100, t) for t in range(6)]
    left = jaccard.needed_entries(spark.createDataFrame(held, "token long, id binary, n long, place int"), jaccard.SHARE)
    assert sorted((r.token, bytes(r.id)) for r in left.collect()) == [(0, b"x"), (1, b"x"), (2, b"x")]


def test_op5_a_pair_of_many_lists_is_given_once(spark):
    import numpy as np
    from skillgauge.llm import jaccard

    base = np.random.default_rng(4).integers(0, 2**63, 200, dtype=np.uint64)
    marks = [int(w) for w in jaccard.sketch(np.unique(base))]
    rows = [(token, bytes([k]), 200, token, bytes([k]), None, None, marks) for token in range(6) for k in range(5)]
    schema = "token long, id binary, n long, place int, label binary, pivot binary, distance double, sketch array<long>"
    reach = jaccard.with_earlier(spark.createDataFrame(rows, schema)).orderBy("id", "token").collect()
    assert [list(r.earlier) for r in reach[:6]] == [list(range(k)) for k in range(6)]
    n, place, near = np.full(5, 200), np.arange(5), np.zeros(5)
    ids = np.array([bytes([k]) for k in range(5)], object)
    held = np.tile(np.array(marks).view(np.uint64), (5, 1))
    given = []
    for token in range(6):
        earlier = np.tile(np.r_[np.arange(token), np.zeros(jaccard.EARLIER - token)].astype(np.int64), (5, 1))
        run = jaccard.Run(ids, ids, ids, n, place * 0 + token, near, held, earlier, np.tile(np.arange(jaccard.EARLIER) < token, (5, 1)))
        i, j = run.pairs(run, jaccard.SHARE, 0.3)
        given += [(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a < b]
    assert len(given) == 10


def test_op5_only_wanted_texts_are_packed(spark):
    from skillgauge.llm import jaccard

    docs = spark.createDataFrame([(k, f"text {k} of some words here") for k in range(300)] + [(None, "no id")], "doc_id long, text string")
    sets = jaccard.described_sets(docs, 5, jaccard.SHARE)
    wanted = sets.where("doc_id in (3, 77) or doc_id is null").selectExpr("key as id", "key", "doc_id as first")
    marks = jaccard.id_filter(wanted.select("first"))
    assert 0 < sum(int(w).bit_count() for w in marks) <= 3
    assert jaccard.packed_texts(docs, wanted, 5).count() == 3


def test_op5_near_copies_of_many_sizes_as_by_brute_force(spark, tmp_path):
    from skillgauge.llm import jaccard

    pick = random.Random(17)
    docs = []
    for size in (5, 9, 30, 180, 700, 2200):
        base = [f"w{pick.randrange(40)}" for _ in range(size)]
        for _ in range(9):
            words = list(base)
            for _ in range(pick.randrange(max(2, size // 30))):
                words[pick.randrange(size)] = f"w{pick.randrange(60)}"
            docs.append((len(docs) + 1, " ".join(words)))
    sets = {}
    for key, text in docs:
        words = text.split()
        sets[key] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    label = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    for rounds in (0, 2):
        found = jaccard.linked_components(spark.createDataFrame(docs, "doc_id long, text string"), lambda: f"{tmp_path}/{random.random()}", rounds=rounds)
        assert sorted(map(tuple, found.collect())) == [(k, len(sets[k]), label[k]) for k in sorted(sets)]
    assert 6 < len(set(label.values())) < len(label)


def test_op5_pairs_of_wide_sketches_take_little_memory():
    import tracemalloc

    import numpy as np
    from skillgauge.llm import jaccard

    drawn = np.random.default_rng(9)
    size, words = jaccard.RUN_SETS, 128
    ids = np.array([k.to_bytes(2) for k in range(size)], object)
    marks = drawn.integers(0, 2**63, (size, words), dtype=np.uint64)
    marks[7] = marks[3]
    none = np.zeros((size, jaccard.EARLIER), np.int64)
    run = jaccard.Run(ids, ids, ids, np.full(size, 9000), np.zeros(size, np.int64), np.zeros(size), marks, none, none.astype(bool))
    tracemalloc.start()
    i, j = run.pairs(run, jaccard.SHARE, 0.3)
    assert tracemalloc.get_traced_memory()[1] < 20e6
    tracemalloc.stop()
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(3, 7), (7, 3)]
