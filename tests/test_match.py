import random
import re

import pytest

from skillgauge.operators.catalog import surfaces, upsert_catalog
from skillgauge.operators.match import build_pattern, match_pairs, unprocessed
from skillgauge.operators.match_large import match_by_grams
from skillgauge.sources.seed import catalog_frame, seed_catalog, seed_rows

NAMES = [
    "Spark", "SQL", "Spark SQL", "Azure", "Azure Data Lake", "CI/CD", "Scikit-learn",
    "C++", "R", ".NET", "über", "İx", "ß", "K8s", "data lake house", "Lake", "Power BI",
]
ATOMS = NAMES + [
    "spark", "ſpark", "K8s", "sql", "ü", " ", "\n", " ", "/", "-", "+", "_",
    "restful", "azure data", "lakehouse", "c++x", "ı", "ix", "STRASSE", "²", "SQL²", "r",
]
JOBS = "job_id string, job_title string, job_description string"


def model(names, texts):
    """Pairs by Python's own regular expressions."""
    ordered = sorted(names, key=lambda n: (-len(n), n))
    pattern = re.compile("|".join(rf"\b{re.escape(n)}\b" for n in ordered), re.I)
    lower = {n.lower(): n for n in ordered}
    return {
        (str(i), lower.get(m.group().lower(), m.group()))
        for i, text in enumerate(texts)
        if text is not None
        for m in pattern.finditer(text)
    }


def catalog(spark, names):
    return catalog_frame(spark, [(n, "c", ["t"]) for n in names])


def jobs(frame, texts):
    return frame([(str(i), f"t{i}", t) for i, t in enumerate(texts)], JOBS)


def pairs(df):
    rows = [(r.job_id, r.skill_name) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("method", [match_pairs, match_by_grams])
def test_random_texts_match_as_the_model(spark, frame, method):
    rng = random.Random(11)
    texts = [
        "".join(rng.choice(ATOMS) + rng.choice([" ", "", ".", "  "])
                for _ in range(rng.randint(0, 14)))
        for _ in range(1500)
    ] + [None, ""]
    expected = model(NAMES, texts)
    assert len(expected) > 2000
    assert pairs(method(jobs(frame, texts), catalog(spark, NAMES))) == expected


@pytest.mark.parametrize("method", [match_pairs, match_by_grams])
def test_seed_catalog_texts(spark, frame, method):
    rng = random.Random(12)
    names = [row[0] for row in seed_rows()]
    words = sorted({w for n in names for w in n.split()}) + ["and", "the", ","]
    texts = [" ".join(rng.choices(words + names, k=12)) for _ in range(600)]
    assert pairs(method(jobs(frame, texts), seed_catalog(spark))) == model(names, texts)


@pytest.mark.parametrize(
    "text, found",
    [
        ("Spark SQL", {"Spark SQL"}),
        ("Spark  SQL", {"Spark", "SQL"}),
        ("Spark SQL", {"Spark", "SQL"}),
        ("Spark\nSQL", {"Spark", "SQL"}),
        ("Azure Data Lakehouse", {"Azure"}),
        ("restful", set()),
        ("REST", {"REST"}),
        ("take a rest", {"REST"}),
        ("ci/cd scikit-learn", {"CI/CD", "Scikit-learn"}),
        ("C++", set()),
        ("C++x", {"C++"}),
        ("SQL_x xSQL SQL2", set()),
        ("SQL, sql; Sql", {"SQL"}),
        ("ſQL", {"ſQL"}),
    ],
)
def test_edge_rules(spark, frame, text, found):
    names = ["Spark", "SQL", "Spark SQL", "Azure", "Azure Data Lake", "REST", "CI/CD",
             "Scikit-learn", "C++"]
    for method in (match_pairs, match_by_grams):
        got = pairs(method(jobs(frame, [text]), catalog(spark, names)))
        assert {name for _, name in got} == found


def test_both_methods_keep_titles_and_schema(spark, frame):
    df = jobs(frame, ["SQL"])
    for method in (match_pairs, match_by_grams):
        result = method(df, catalog(spark, ["SQL"]))
        assert result.columns == ["job_id", "job_title", "skill_name"]
        assert [tuple(r) for r in result.collect()] == [("0", "t0", "SQL")]


def test_a_catalog_beyond_the_limit_is_joined(spark, frame):
    df = match_pairs(jobs(frame, ["a b c"]), catalog(spark, ["a", "b c"]), pattern_names=1)
    assert pairs(df) == {("0", "a"), ("0", "b c")}
    assert "regexp_extract_all(job_description" in df._jdf.queryExecution().toString()


def test_both_branches_give_each_equal_row_its_pairs(spark, frame):
    names = ["Spark", "SQL", "Spark SQL", "data lake house", "R"]
    text = "spark sql, SQL and R in a Data Lake House; sql"
    same = [("1", "t", text)] * 3 + [(None, "t", text)] * 2 + [("t", None, text)] * 2
    same += [(None, None, "R, r")] * 4 + [("1", "t", "SQL")] * 2 + [("1", "u", text)]
    same += [("2", "t", None)] * 2 + [("3", "t", "none")] * 2
    df = frame(same, JOBS)
    by_pattern, by_grams = (
        sorted((tuple(r) for r in match_pairs(df, catalog(spark, names), pattern_names=n).collect()), key=repr)
        for n in (100, 1)
    )
    assert by_grams == by_pattern
    assert len(by_pattern) == 8 * 4 + 4 + 2


def test_many_copies_of_a_row_are_all_kept(spark, frame):
    df = frame([("1", "t", "b c a")], JOBS).crossJoin(spark.range(25_001)).drop("id")
    got = match_by_grams(df, catalog(spark, ["a", "b c"])).groupBy("skill_name").count()
    assert {tuple(r) for r in got.collect()} == {("a", 25_001), ("b c", 25_001)}


def test_empty_catalog_gives_an_empty_frame(spark, frame):
    empty = seed_catalog(spark).limit(0)
    for method in (match_pairs, match_by_grams):
        result = method(jobs(frame, ["SQL"]), empty)
        assert result.columns == ["job_id", "job_title", "skill_name"]
        assert result.count() == 0


def test_variants(spark, frame):
    rows = [
        ("Power BI", ["powerbi", "power-bi", "SQL"]),
        ("SQL", None),
        ("Go", ["golang", "", None]),
    ]
    names = spark.createDataFrame(rows, "skill_name string, variants array<string>")
    names = names.selectExpr("*", "'c' as category", "array('t') as tags")
    df = jobs(frame, ["PowerBI", "power-bi and sql", "GOLANG"])
    assert pairs(match_pairs(df, names)) == {("1", "SQL")}
    expected = {("0", "Power BI"), ("1", "Power BI"), ("1", "SQL"), ("2", "Go")}
    for method in (match_pairs, match_by_grams):
        assert pairs(method(df, names, match_variants=True)) == expected
    spelled = {r.lower: r.skill_name for r in surfaces(names).collect()}
    assert spelled["sql"] == "SQL" and spelled["power-bi"] == "Power BI"


def test_names_that_differ_in_case_only(spark, frame):
    got = pairs(match_pairs(jobs(frame, ["r R"]), catalog(spark, ["R", "r"])))
    assert got == model(["R", "r"], ["r R"]) == {("0", "r")}


def test_pattern_of_many_names_stays_exact():
    rng = random.Random(1)
    names = sorted({"".join(rng.choices("abc -", k=rng.randint(1, 6))).strip() for _ in range(400)} - {""})
    text = "".join(rng.choices("abcABC -.", k=3000))
    ordered = sorted(names, key=lambda n: -len(n))
    plain = re.compile("|".join(rf"\b{re.escape(n)}\b" for n in ordered), re.I)
    # The pattern uses nothing that differs between Java and Python here.
    ours = build_pattern(names).removeprefix("(?iu)").replace(r"\p{L}\p{N}_", r"\w")
    assert re.compile(ours, re.I).findall(text) == plain.findall(text)


def test_unprocessed(frame):
    df = frame(
        [("1", None, "x"), ("2", "2024-01-01", "x"), ("3", None, None), ("4", None, "")],
        "job_id string, skill_extraction_date string, job_description string",
    )
    assert sorted(r.job_id for r in unprocessed(df).collect()) == ["1", "4"]


def test_seed():
    rows = seed_rows()
    assert len(rows) == 95
    assert len({name.lower() for name, _, _ in rows}) == 95
    assert len({tag for _, _, tags in rows for tag in tags}) == 80


def test_upsert(spark):
    from pyspark.sql import functions as F

    old_time, new_time = F.lit("2024-01-01 00:00:00"), F.lit("2024-02-01 00:00:00")
    empty = spark.createDataFrame([], "skill_id string, skill_name string, category string, "
                                  "tags array<string>, variants array<string>, "
                                  "created_at timestamp_ntz")
    first = upsert_catalog(empty, seed_catalog(spark), old_time)
    assert first.count() == 95
    assert first.filter("skill_id is null or size(variants) <> 0").count() == 0
    again = upsert_catalog(first, seed_catalog(spark), old_time)
    assert again.exceptAll(first).count() == 0 == first.exceptAll(again).count()

    batch = spark.createDataFrame(
        [("SQL", None, None), ("New", "x", ["y"])],
        "skill_name string, category string, tags array<string>",
    )
    merged = {r.skill_name: r for r in upsert_catalog(first, batch, new_time).collect()}
    before = {r.skill_name: r for r in first.collect()}
    assert len(merged) == 96
    assert merged["SQL"].category is None and merged["SQL"].tags == []
    assert merged["SQL"].skill_id == before["SQL"].skill_id
    assert str(merged["SQL"].created_at) == "2024-02-01 00:00:00"
    assert str(merged["Java"].created_at) == "2024-01-01 00:00:00"
    assert merged["New"].tags == ["y"]
    with pytest.raises(Exception, match="skill twice in batch: New"):
        upsert_catalog(first, batch.unionByName(batch.filter("category = 'x'")), new_time).collect()
