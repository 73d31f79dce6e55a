import random

import pytest
from pyspark.sql import functions as F

from skillgauge.operators import joins, merge, quality
from skillgauge.plans import registry

KEYS = ["source", "job_source_id"]
BATCH = "source string, job_source_id string, file string, title string"
PAIRS = "job_id string, job_title string, skill_name string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_first_row_of_each_key_wins(frame):
    batch = frame(
        [("s", "1", "b", "late"), ("s", "1", "a", "early"), ("s", "2", "c", None)], BATCH
    )
    got = merge.dedup(batch, KEYS, ["file"])
    assert got.columns == batch.columns
    assert rows(got, "job_source_id", "title") == [("1", "early"), ("2", None)]
    copies = merge.first_per_key(batch, KEYS, ["file"])
    assert rows(copies, "job_source_id", "copies") == [("1", 2), ("2", 1)]


def test_rows_with_a_null_key_all_stay(frame):
    batch = frame(
        [("s", None, "a", "x"), ("s", None, "b", "x"), (None, None, "c", "x"),
         ("s", "1", "d", "x"), ("s", "1", "e", "x")],
        BATCH,
    )
    assert rows(merge.dedup(batch, KEYS, ["file"]), "file") == [("a",), ("b",), ("c",), ("d",)]
    target = frame([("s", None), (None, None), ("s", "1")], "source string, job_source_id string")
    new = merge.absent_rows(batch, target, KEYS, ["file"])
    assert rows(new, "file") == [("a",), ("b",), ("c",)]
    ids = merge.absent_rows(batch, target, KEYS, ["file"], id_name="job_id")
    assert ids.columns == ["job_id", *batch.columns]
    assert ids.select("job_id").distinct().count() == 3


def test_equal_rows_with_a_null_key_all_stay(frame):
    batch = frame([("s", None, "a", "x")] * 7 + [("s", "1", "a", "x")] * 7, BATCH)
    assert rows(merge.dedup(batch, KEYS, ["file"]), *KEYS) == sorted(
        [("s", None)] * 7 + [("s", "1")], key=repr
    )
    target = frame([("s", "2")], "source string, job_source_id string")
    new = merge.absent_rows(batch, target, KEYS, ["file"], id_name="job_id")
    assert new.count() == 8 == new.select("job_id").distinct().count()


def test_absent_rows_and_repeat(frame):
    batch = frame([("s", str(i % 50), f"{i:03d}", "t") for i in range(200)], BATCH)
    target = frame([("s", str(i)) for i in range(20)], "source string, job_source_id string")
    new = merge.absent_rows(batch, target, KEYS, ["file"])
    assert rows(new, "job_source_id", "file") == sorted(
        ((str(i), f"{i:03d}") for i in range(20, 50)), key=repr
    )
    again = merge.absent_rows(batch, target.unionByName(new.select(*KEYS)), KEYS, ["file"])
    assert again.count() == 0


def test_dedup_and_anti_join_share_one_shuffle_of_the_batch(frame, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = frame([("s", "1", "a", "t")], BATCH)
        target = frame([("s", "2")], "source string, job_source_id string")
        df = merge.absent_rows(batch, target, KEYS, ["file"])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # batch and target


def test_other_keys(frame):
    batch = frame([("s", "1", "a", "u1"), ("s", "2", "b", "u1"), ("s", "3", "c", "u2")], BATCH)
    target = frame([("u2",)], "title string")
    assert rows(merge.absent_rows(batch, target, ["title"], ["file"]), "file") == [("a",)]


@pytest.fixture
def tables(frame):
    skills = frame([("SQL", "k1"), ("Java", "k2")], "skill_name string, skill_id string")
    jobs = frame([("1",), ("2",), ("3",)], "job_id string")
    stored = frame([("2", "k1")], "job_id string, skill_id string")
    return skills, jobs, stored


def test_pair_status_mix(frame, tables):
    pairs = frame(
        [("1", "t", "SQL"), ("1", "t", "SQL"), ("1", "t", "SQL"), ("1", "t", "Java"),
         ("2", "t", "SQL"), ("2", "t", "SQL"), ("2", None, "Java"), ("1", "t", "Nope"),
         ("9", "t", "SQL"), (None, "t", "SQL"), ("3", "x" * 256, "SQL"),
         ("3", "x" * 255 + "  ", "Java")],
        PAIRS,
    )
    status = merge.pair_status(pairs, *tables)
    assert rows(status, "job_id", "skill_name", "status", "n_rows") == sorted(
        [("1", "SQL", "inserted", 1), ("1", "SQL", "duplicate", 2),
         ("1", "Java", "inserted", 1), ("2", "SQL", "duplicate", 2),
         ("2", "Java", "inserted", 1), ("1", "Nope", "failed", 1),
         ("9", "SQL", "failed", 1), (None, "SQL", "failed", 1),
         ("3", "SQL", "failed", 1), ("3", "Java", "inserted", 1)],
        key=repr,
    )
    summary = quality.load_summary(status).first()
    assert tuple(summary) == (4, 4, 4, 12)
    new = merge.pairs_to_insert(status, F.lit("2024-01-01 00:00:00"))
    assert rows(new, "job_id", "skill_id", "extraction_method") == [
        ("1", "k1", "regex"), ("1", "k2", "regex"), ("2", "k2", "regex"), ("3", "k2", "regex")
    ]
    assert new.select("job_skill_id").distinct().count() == 4


def test_pair_status_counts_add_up_and_a_second_load_inserts_nothing(frame, tables):
    skills, jobs, stored = tables
    rng = random.Random(2)
    data = [(rng.choice("1239"), "t", rng.choice(["SQL", "Java", "Go"])) for _ in range(300)]
    pairs = frame(data, PAIRS)
    status = merge.pair_status(pairs, skills, jobs, stored)
    first = quality.load_summary(status).first()
    assert first.total == 300 == first.inserted + first.duplicates + first.failed
    now = F.lit("2024-01-01 00:00:00")
    loaded = stored.unionByName(
        merge.pairs_to_insert(status, now).select("job_id", "skill_id")
    )
    second = quality.load_summary(merge.pair_status(pairs, skills, jobs, loaded)).first()
    assert (second.inserted, second.failed) == (0, first.failed)


def test_empty_load(frame, tables):
    status = merge.pair_status(frame([], PAIRS), *tables)
    assert tuple(quality.load_summary(status).first()) == (0, 0, 0, 0)


def test_mark_processed(frame):
    jobs = frame(
        [("1", None), ("2", "2023-01-01 00:00:00"), ("3", None)],
        "job_id string, skill_extraction_date string",
    ).withColumn("skill_extraction_date", F.col("skill_extraction_date").cast("timestamp_ntz"))
    done = frame([("1",), ("1",)], "job_id string")
    got = merge.mark_processed(jobs, done, F.lit("2024-01-01 00:00:00"))
    assert [(r[0], str(r[1])) for r in got.orderBy("job_id").collect()] == [
        ("1", "2024-01-01 00:00:00"), ("2", "2023-01-01 00:00:00"), ("3", "None")
    ]


def test_cascade_and_orphans(frame):
    pairs = frame([("1", "a"), ("1", "b"), ("2", "a"), (None, "a")], "job_id string, skill_id string")
    gone = frame([("1",), (None,)], "job_id string")
    left = merge.cascade_delete(pairs, gone, "job_id", ["skill_id"])
    assert rows(left, "job_id", "skill_id") == sorted([("2", "a"), (None, "a")], key=repr)
    parents = frame([("1",)], "job_id string")
    assert rows(merge.orphans(pairs, parents, "job_id", ["skill_id"]), "job_id") == [("2",)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_lookup_beyond_the_limit_gives_the_same_join(frame, how):
    large = frame([(i, "hot" if i % 3 else f"k{i}") for i in range(900)], "i int, k string")
    lookup = frame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    small = joins.lookup_join(large, lookup, ["k"], how, ["i"])
    salted = joins.lookup_join(large, lookup, ["k"], how, ["i"], rows=1)
    assert sorted(small.columns) == sorted(salted.columns)
    columns = small.columns
    assert rows(small, *columns) == rows(salted, *columns)
    assert "_salt" in salted._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_lookup_beyond_the_limit_is_not_broadcast(frame, how):
    large = frame([(i, f"k{i}") for i in range(90)], "i int, k string")
    lookup = frame([("k1", 1), ("k3", 2), ("none", 3)], "k string, v int")
    plan = joins.lookup_join(large, lookup, ["k"], how, ["i"], rows=1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


RULES = {"source": 3, "title": 5}


def test_row_rules(frame):
    data = frame(
        [("ok", "abc", "2024-01-01"), ("long", "abc", None), ("ok", "abcdef", None),
         ("ok", "abcde   ", None), (None, "a", None), ("ok", "a\0", None),
         ("ok", "ünïcö", "soon"), ("ok", None, "")],
        "source string, title string, posted string",
    )
    checked = quality.row_errors(data, RULES, required=["source"], dates=["posted"])
    assert [r.error_reason for r in checked.collect()] == [
        None, "too_long:source", "too_long:title", None, "missing:source", "nul:title",
        "bad_date:posted", "bad_date:posted",
    ]
    good = checked.filter("error_reason is null").drop("error_reason")
    kept = quality.stored_values(good, RULES, dates=["posted"])
    assert rows(kept, "title") == [("abc",), ("abcde",)]
    assert dict(kept.dtypes)["posted"] == "date"


def test_row_quality_reads_whole_documents_and_all_rules(frame, tmp_path):
    docs = [
        (1, "title\nbody", "en", "s"), (2, "title\nfine\nlast \0 line", "en", "s"),
        (3, None, "en", "s"), (4, "title", "en", None), (5, "title", "en", "s" * 51),
        (6, "title", "x" * 256, "s"), (7, "title", "x" * 480, "s"), (8, "t" * 256, "en", "s"),
        (9, "title\nbody", "de", "s"), (10, "no order", "fr", "s" * 50),
    ]
    frame(docs, "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    orders = [(i, i, "2024-01-31") for i in range(1, 10)]
    frame(orders, "o_orderkey long, o_custkey long, o_orderdate string").selectExpr(
        "o_orderkey", "o_custkey", "to_timestamp(o_orderdate) as o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    checked = registry.row_quality(frame([(1,)], "i int").sparkSession, str(tmp_path))
    assert {int(r.job_source_id): r.error_reason for r in checked.collect()} == {
        1: None, 2: "nul:job_description", 3: "missing:job_title", 4: "missing:source",
        5: "too_long:source", 6: "too_long:country", 7: "too_long:country",
        8: "too_long:job_title", 9: "bad_date:posted_date", 10: None,
    }


def test_parse_metrics(frame):
    parsed = frame(
        [("1", None), ("1", None), ("1", None), ("2", None), (None, "bad_json"), (None, "bad_json")],
        "job_source_id string, error_reason string",
    )
    assert tuple(quality.parse_metrics(parsed).first()) == (6, 2, 2, 2)
    assert tuple(quality.parse_metrics(parsed.limit(0)).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_only_hot_keys_of_a_large_lookup_are_repeated(frame, how, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    hot_keys = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda large, on: hot_keys(large, on, 20))
    rows = [(i, "hot" if i % 2 else None if i % 3 else f"k{i}") for i in range(120)]
    large = frame(rows, "i int, k string")
    lookup = frame([(f"k{i}", i) for i in range(0, 200, 4)] + [("hot", 1), (None, 2)], "k string, v int")
    found = joins.lookup_join(large, lookup, ["k"], how, ["i"], rows=1, read_twice=True)
    plain = large.join(lookup, ["k"], how)
    columns = sorted(plain.columns)
    assert sorted(map(repr, found.select(columns).collect())) == sorted(map(repr, plain.select(columns).collect()))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert len(joins.hot_keys(large, ["k"])) == 2  # "hot" and null


def test_a_lookup_of_orphans_is_not_repeated(frame, monkeypatch):
    repeated = []
    explode = joins.F.explode
    monkeypatch.setattr(joins.F, "explode", lambda c: repeated.append(c) or explode(c))
    monkeypatch.setattr(joins, "fits", lambda lookup, rows=0: False)
    children = frame([(f"k{i % 50}", i) for i in range(300)] + [(None, 1)], "k string, s int")
    parents = frame([(f"k{i}",) for i in range(40)], "k string")
    left = merge.orphans(children, parents, "k", ["s"])
    assert sorted(r.s for r in left.collect()) == [i for i in range(300) if i % 50 >= 40]
    (salts,) = repeated
    assert parents.select(joins.F.size(salts)).distinct().collect() == [(1,)]
    assert merge.cascade_delete(children, parents, "k", ["s"]).count() == 61
