"""Reports kept as state, the search index, count matrices, declared keys, streams."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skillgauge.operators import bitmaps, constraints, joins, search_index
from skillgauge.operators.frequent import frequent_pairs
from skillgauge.sources.tables import append_load
from skillgauge.streaming.dedup import first_seen
from skillgauge.streaming.downloads import count_stream, streamed_downloads, with_missing_days

PAIRS = "job_id long, skill_name string"


def test_bitmaps_follow_loads(spark, frame, tmp_path):
    root = str(tmp_path)
    number = F.col("job_id")

    def load(name, rows):
        append_load(frame(rows, PAIRS), root, "pairs", name)
        return bitmaps.update_bitmaps(spark, root, PAIRS, number, pairs="pairs")

    def counts():
        return {r.skill_name: r.job_count for r in bitmaps.bitmap_counts(spark, root).collect()}

    assert load("1", [(1, "a"), (2, "a"), (2, "a"), (40000, "a"), (1, "b")]) == ["1"]
    assert counts() == {"a": 3, "b": 1}
    # A pair that an earlier load has counts once, and only the new load is read.
    assert load("2", [(1, "a"), (3, "a"), (9, "c")]) == ["2"]
    assert counts() == {"a": 4, "b": 1, "c": 1}
    assert bitmaps.update_bitmaps(spark, root, PAIRS, number, pairs="pairs") == []
    assert load("1", [(7, "b"), (8, "b")]) == ["1"]
    assert counts() == {"a": 2, "b": 2, "c": 1}
    assert [r.skill_name for r in bitmaps.top_skills(spark, root, 2).collect()] == ["a", "b"]


def test_pairs_by_count_matrix(spark, tmp_path):
    rng = random.Random(2)
    names = list("abcdef")
    sets = [rng.choices([*names, "unknown"], k=rng.randrange(0, 6)) for _ in range(500)] + [None, []]
    rows = [tuple(r) for r in frequent_pairs(spark.createDataFrame([(s,) for s in sets], "s array<string>").repartition(5), [*names, "a"], 0.1, str(tmp_path / "a")).collect()]
    single = Counter(n for s in sets for n in set(s or []) if n in names)
    both = Counter(p for s in sets for p in itertools.combinations(sorted(set(s or []) & set(names)), 2))
    n = len(sets)
    want = [(a, b, c, round(c / n, 6), round(c * n / (single[a] * single[b]), 6)) for (a, b), c in both.items() if c / n >= 0.1]
    assert sorted(rows) == sorted(want) and rows
    assert frequent_pairs(spark.createDataFrame([], "s array<string>"), names, 0.1, str(tmp_path / "b")).collect() == []


def test_search_by_blocks(spark, frame):
    rng = random.Random(4)
    texts = [(str(i), " ".join(rng.choices(["Red", "blue", "über", "x"], [1, 5, 2, 9], k=rng.randrange(0, 40)))) for i in range(400)] + [("n", None)]
    jobs = frame(texts, "job_id string, job_description string")
    index = search_index.build_index(jobs, 32).cache()
    for words, k in ((["red", "ÜBER"], 5), (["blue"], 7), (["red", "none"], 3), ([], 3)):
        asked = {w.lower() for w in words}
        counts = {i: Counter((t or "").lower().split()) for i, t in texts}
        df = {w: sum(c[w] > 0 for c in counts.values()) for w in asked}
        want = sorted((-sum(c[w] * math.log(len(texts) / df[w]) for w in asked), i) for i, c in counts.items() if asked and all(c[w] for w in asked))[:k]
        got = [(r.job_id, round(r.score, 9)) for r in search_index.search(index, words, len(texts), k, 32).collect()]
        assert got == [(i, round(-s, 9)) for s, i in want]
    index.unpersist()


def test_an_index_shuffles_texts_once_and_no_words(frame):
    texts = frame([("1", "a b a"), ("2", "b"), ("2", "b c"), (None, "a"), ("3", None)], "job_id string, job_description string")
    index = search_index.build_index(texts, 4)
    assert index._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    rows = index.select("word", F.inline("postings")).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(
        [("a", "1", 2), ("b", "1", 1), ("b", "2", 2), ("c", "2", 1), ("a", None, 1)], key=repr
    )


def test_deletes_go_down_all_levels(spark, frame):
    key = constraints.ForeignKey
    keys = [key("b", "a_id", "a", ("b_id",)), key("c", "b_id", "b", ("c_id",)), key("c", "a_id", "a", ("c_id",))]
    primary = {"a": "a_id", "b": "b_id", "c": "c_id"}
    tables = {
        "c": frame([(1, 1, 3), (2, 2, 3), (3, 3, 1), (4, None, None), (5, 4, 2)], "c_id int, b_id int, a_id int"),
        "b": frame([(1, 1), (2, 2), (3, 3), (4, 3)], "b_id int, a_id int"),
        "a": frame([(1,), (2,), (3,)], "a_id int"),
    }
    left = constraints.delete_rows(tables, {"a": frame([(1,)], "a_id int"), "b": frame([(4,)], "b_id int")}, keys, primary)
    assert {name: sorted(r[0] for r in df.collect()) for name, df in left.items()} == {"a": [2, 3], "b": [2, 3], "c": [2, 4]}
    found = constraints.rows_without_parent({"b": tables["b"], "a": left["a"]}, keys, primary)
    assert [r.b_id for r in found["b", "a_id"].collect()] == [1]
    with pytest.raises(ValueError, match="circle"):
        constraints.levels(["a", "b"], [key("a", "x", "b", ()), key("b", "y", "a", ())])


def test_deletes_of_many_rows_broadcast_nothing(frame, monkeypatch):
    monkeypatch.setattr(joins, "fits", lambda lookup, rows=0: False)
    keys = [constraints.ForeignKey("b", "a_id", "a", ("b_id",))]
    tables = {"a": frame([(i,) for i in range(9)], "a_id int"), "b": frame([(i, i % 9) for i in range(40)], "b_id int, a_id int")}
    gone = {"a": frame([(1,), (2,)], "a_id int"), "b": frame([(3,)], "b_id int")}
    left = constraints.delete_rows(tables, gone, keys, {"a": "a_id", "b": "b_id"})["b"]
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.b_id for r in left.collect()) == [i for i in range(40) if i % 9 not in (1, 2) and i != 3]


def test_first_seen_over_batches(spark, frame, tmp_path):
    root = str(tmp_path)
    batches = [
        [("a", 5), ("a", 3), ("b", 9), (None, 1)],
        [("a", 1), ("c", 2), (None, 1), (None, 1)],
        [("c", 1), ("b", 1), ("d", 4), ("d", 4)],
    ]
    for rows in batches:
        frame(rows, "k string, n long").repartition(2).write.mode("append").parquet(f"{root}/in")
        kept = first_seen(spark.readStream.schema("k string, n long").parquet(f"{root}/in"), ["k"], ["n"])
        kept.writeStream.foreachBatch(lambda batch, no: append_load(batch, root, "kept", str(no)) and None).option(
            "checkpointLocation", f"{root}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
    from skillgauge.sources.tables import read_table

    got = [(r.k, r.n) for r in read_table(spark, root, "kept", "k string, n long").collect()]
    assert sorted(got, key=repr) == sorted([("a", 3), ("b", 9), ("c", 2), ("d", 4), (None, 1), (None, 1), (None, 1)], key=repr)


def test_late_downloads_and_missing_days(spark, frame, tmp_path):
    root = str(tmp_path)
    days = [["2024-01-01", "2024-01-01", "2024-01-03"], ["2024-01-02", "2024-01-20"], ["2024-01-02", "2024-01-19"]]
    for part in days:
        rows = frame([("p", d) for d in part], "package_id string, d string").select("package_id", F.to_timestamp("d").alias("ts"))
        rows.write.mode("append").parquet(f"{root}/in")
        count_stream(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), root, f"{root}/checkpoint").awaitTermination()
    got = streamed_downloads(spark, root, F.lit("2024-02-01"))
    # The second 2 January came after the watermark had passed that day.
    assert sorted((str(r.date), r.downloads) for r in got.collect()) == [
        ("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-03", 1), ("2024-01-19", 1), ("2024-01-20", 1)
    ]
    filled = with_missing_days(got.select("package_id", "date", "downloads"))
    assert filled.count() == 20 and filled.agg(F.sum("downloads")).first()[0] == 6
    assert with_missing_days(got.limit(0).select("package_id", "date", "downloads")).count() == 0
