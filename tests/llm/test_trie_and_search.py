"""The trie, ranked search and decontamination against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("skillgauge.llm")

from skillgauge.llm import phrases, postings, queries, ranked, trie  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TALKS = "conv_id long, turn long, role string, text string, depth string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- trie -------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, role, tie, text))
    own = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    out = []
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        saved = sum((len(members[k]) - 1) * len([w for w in re.split(r"[\x20\x09-\x0D]+", k[-1][1]) if w]) for k in below if k)
        ends = sorted(c for c in convs if len(made[c]) == len(key))
        out.append((
            min(convs), len(key), min(members[key[:-1]]) if key else -1, len(convs), len(kids[key]),
            sum(not kids[k] for k in below), saved, sha(",".join(map(str, ends))),
        ))
    return sorted(out)


def run_trie(spark, path):
    rows = queries.op11_prefix_trie(spark, path).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows)


def written(spark, tmp_path, name, rows, schema):
    path = str(tmp_path / "data")
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return path


def test_trie_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert run_trie(spark, SMALL) == plain_trie(rows)


def test_trie_of_odd_rows(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for c in [*range(0, 130), -3, -20, 4000]:
        for t in range(rng.randrange(0, 6)):
            rows.append((c, rng.choice([None, t, t, 1]), rng.choice(["user", None, ""]), rng.choice(["a b", "", None, "x  y\tz é", "b"]), "clash"))
    rows += rows[:40]
    rows += [(None, 1, "user", "lost", None), (500, 1, "u", "w " * 30000, None)]
    rows += [(c, t, "u", "same", None) for c in (601, 602, 603, 620) for t in range(40)]
    path = written(spark, tmp_path, "conversations", rows, TALKS)
    assert run_trie(spark, path) == plain_trie(rows)


def test_trie_with_a_full_sketch(spark, tmp_path, monkeypatch):
    """Screening may only cost work, also when nearly all counters are hit twice."""
    monkeypatch.setattr(trie, "LEAST_WIDTH", 16)
    monkeypatch.setattr(trie, "MAX_WIDTH", 16)
    monkeypatch.setattr(trie, "RUN", 3)
    rows = [(c, t, "u", f"{t % 2} {c % (t + 1)}", None) for c in range(60) for t in range(9)]
    path = written(spark, tmp_path, "conversations", rows, TALKS)
    assert run_trie(spark, path) == plain_trie(rows)


def test_trie_of_nothing(spark, tmp_path):
    path = written(spark, tmp_path, "conversations", [], TALKS)
    assert run_trie(spark, path) == []
    path = written(spark, tmp_path, "conversations", [(None, 1, "u", "x", None)], TALKS)
    assert run_trie(spark, path) == []


def test_screening_never_hides_a_shared_prefix(spark):
    rows = [(i, 1, i % 50, (i % 50) * 7, 0, 0) for i in range(200)] + [(i, 1, i, -i, 0, 0) for i in range(1000, 1100)]
    frame = spark.createDataFrame(rows, "conv_id long, depth long, x1 long, x2 long, p1 long, p2 long")
    flags = {r.conv_id: r.shared for r in trie.screened(frame).collect()}
    assert all(flags[i] for i in range(200)) and sum(flags[i] for i in range(1000, 1100)) < 10


# --- words --------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_words_and_sizes():
    import pyarrow as pa

    texts = [None, "", "A-b c", "é😀x|Y", "--", "tail", "head", "\x00a\x7fb", "ÀB c9"]
    found, sizes = postings.split_words(pa.array(texts))
    assert found.to_pylist() == [w for t in texts for w in words(t)]
    assert list(sizes) == [len(words(t)) for t in texts]
    part = pa.array(["skip me", "a b", "c"])[1:]
    assert postings.split_words(part)[0].to_pylist() == ["a", "b", "c"]


# --- ranked search --------------------------------------------------------------


def plain_ranked(docs, items, k=10):
    split = [(d, words(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    counts = [(d, len(w), Counter(w)) for d, w in split]
    out = []
    for item, text in set(items):
        asked = Counter(words(text))
        found = []
        for d, n, tf in counts:
            m = 100 - 75 + (75 * n * n_docs) // max(n_terms, 1)
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, times in asked.items() if tf[t]
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def tables(spark, tmp_path, docs, items):
    path = str(tmp_path / "data")
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, term string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, shard long").write.parquet(f"{path}/benchmark.parquet")
    return path


def given(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    return docs, [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]


def odd_tables():
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    docs = [(i, text(rng.randrange(0, 60))) for i in range(300)]
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 25, 40]))) for i in range(30)]
    items += [(40, None), (41, ""), (42, "!!"), (3, "w1 w1 w1 w2"), (None, "w1 w2 w3"), (50, "never seen words"), items[0], (51, items[5][1])]
    docs += [(7, docs[8][1]), (7, docs[8][1]), (-4, "w1"), (None, "w1 w2 w3"), (900, None), (901, ""), (902, "é " * 20000 + items[10][1])]
    docs += [(1000 + i, f"{text(5)} {items[i][1].upper()}, {text(7)} {items[i][1]}") for i in range(30)]
    docs += [(2000 + i, " ".join(rng.sample(items[i][1].split(), len(items[i][1].split())))) for i in range(30)]
    return docs, items


def ranked_rows(spark, path):
    rows = queries.op12_ranked_search(spark, path).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=repr)


def test_ranking_of_a_table(spark):
    assert ranked_rows(spark, SMALL) == plain_ranked(*given(spark, SMALL))


@pytest.mark.parametrize("limits", [(2**21, 8000, 4), (200, 40, 7)])
def test_ranking_of_odd_rows(spark, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(ranked, "BUNDLE_WORDS", limits[1])
    monkeypatch.setattr(postings.build_index, "__defaults__", (limits[0],))
    monkeypatch.setattr(ranked.search, "__defaults__", (limits[2],))
    docs, items = odd_tables()
    assert ranked_rows(spark, tables(spark, tmp_path, docs, items)) == plain_ranked(docs, items)


def test_ranking_of_nothing(spark, tmp_path):
    assert ranked_rows(spark, tables(spark, tmp_path, [], [(1, "a")])) == []
    assert ranked_rows(spark, tables(spark, tmp_path / "b", [(1, "a")], [])) == []


# --- decontamination --------------------------------------------------------------


def plain_contamination(docs, items, near=20):
    windows = defaultdict(set)
    for item, text in items:
        asked = words(text)
        size = min(10, len(asked))
        for i in range(len(asked) - size + 1 if asked and item is not None else 0):
            windows[tuple(asked[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    totals = Counter(w for _, t in docs for w in words(t))
    out = []
    for d, text in docs:
        have, hit, found, around = words(text), set(), set(), set()
        for size in sizes:
            for i in range(len(have) - size + 1):
                for item in windows.get(tuple(have[i : i + size]), ()):
                    found.add(item)
                    hit.update(range(i, i + size))
        places = defaultdict(list)
        for i, w in enumerate(have):
            places[w].append(i)
        for window, names in windows.items():
            if names <= around or not all(w in places for w in window):
                continue
            rare = min(window, key=lambda w: totals[w])
            if any(all(any(abs(p - q) <= near for q in places[w]) for w in window) for p in places[rare]):
                around |= names
        out.append((d, len(have), len(hit), len(found), sha(",".join(sorted(found))), bool(hit), len(around - found)))
    return sorted(out, key=repr)


def contamination_rows(spark, path):
    return sorted(map(tuple, queries.op13_decontamination(spark, path).collect()), key=repr)


def test_contamination_of_a_table(spark):
    assert contamination_rows(spark, SMALL) == plain_contamination(*given(spark, SMALL))


@pytest.mark.parametrize("limits", [(2**21, 100_000, 2**20), (200, 60, 4)])
def test_contamination_of_odd_rows(spark, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", limits[1])
    monkeypatch.setattr(phrases, "CANDIDATES", limits[2])
    monkeypatch.setattr(postings.build_index, "__defaults__", (limits[0],))
    docs, items = odd_tables()
    got, want = contamination_rows(spark, tables(spark, tmp_path, docs, items)), plain_contamination(docs, items)
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert got == want


def test_contamination_of_nothing(spark, tmp_path):
    assert contamination_rows(spark, tables(spark, tmp_path, [], [(1, "a")])) == []
    assert contamination_rows(spark, tables(spark, tmp_path / "b", [(1, "a")], [])) == [(1, 1, 0, 0, sha(""), False, 0)]
