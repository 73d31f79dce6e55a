import random
from collections import defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from skillgauge.operators import analytics

SKILLS = [
    ("k0", "Python", "language", ["general", "scripting"]),
    ("k1", "SQL", "language", ["query", "standard"]),
    ("k2", "airflow", "tool", ["workflow", "scripting"]),
    ("k3", "AWS", None, ["cloud"]),
    ("k4", "dbt", "tool", None),
    ("k5", "Kafka", "stream", []),
    ("k6", "Go'lang", "language", ["scripting", None]),
]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    pairs = set()
    for job in range(60):
        pairs.add((str(job), "k1"))
        for _ in range(rng.randint(0, 4)):
            pairs.add((str(job), rng.choice(SKILLS)[0]))
    return sorted(pairs)


@pytest.fixture
def skills(frame):
    return frame(SKILLS, "skill_id string, skill_name string, category string, tags array<string>")


@pytest.fixture
def job_skills(frame, data):
    names = {s[0]: s[1] for s in SKILLS}
    rows = [(job, skill, names[skill]) for job, skill in data]
    # A repeated row counts once.
    return frame(rows + rows[:10], "job_id string, skill_id string, skill_name string")


def top(jobs_of, limit):
    counts = [(name, len(jobs)) for name, jobs in jobs_of.items()]
    return sorted(counts, key=lambda c: (-c[1], c[0]))[:limit]


def tuples(df):
    return [tuple(r) for r in df.collect()]


def by_name(data):
    names = {s[0]: s[1] for s in SKILLS}
    jobs = defaultdict(set)
    for job, skill in data:
        jobs[names[skill]].add(job)
    return jobs


def test_counts_and_top(job_skills, data):
    assert tuples(analytics.skill_counts(job_skills)) == top(by_name(data), 99)
    assert tuples(analytics.top_skills(job_skills, 3)) == top(by_name(data), 3)
    plan = analytics.top_skills(job_skills)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_lists(job_skills, skills):
    assert [r[0] for r in analytics.all_skills(job_skills).collect()] == [
        "AWS", "Go'lang", "Kafka", "Python", "SQL", "airflow", "dbt"
    ]
    assert [r[0] for r in analytics.all_skills(job_skills, "UNICODE").collect()] == [
        "airflow", "AWS", "dbt", "Go'lang", "Kafka", "Python", "SQL"
    ]
    assert [r[0] for r in analytics.all_categories(skills).collect()] == [
        "language", "stream", "tool"
    ]
    tags = [r[0] for r in analytics.all_tags(skills).collect()]
    assert tags == [None, "cloud", "general", "query", "scripting", "standard", "workflow"]


def test_cooccurring(job_skills, data):
    jobs_of = by_name(data)
    for chosen in ("Python", "Go'lang", "nothing"):
        holders = jobs_of.get(chosen, set())
        expected = {n: j & holders for n, j in jobs_of.items() if n != chosen and j & holders}
        got = tuples(analytics.cooccurring_skills(job_skills, chosen))
        assert got == top(expected, 15)
        # The same as the plain self join.
        a, b = job_skills.alias("a"), job_skills.alias("b")
        joined = a.join(b, "job_id").filter(
            (F.col("a.skill_name") == chosen) & (F.col("b.skill_name") != chosen)
        )
        plain = joined.groupBy("b.skill_name").agg(F.countDistinct("job_id"))
        assert sorted(got) == sorted(tuples(plain))


def test_by_category(job_skills, skills, data):
    names = {s[1] for s in SKILLS if s[2] == "language"}
    expected = {n: j for n, j in by_name(data).items() if n in names}
    assert tuples(analytics.skills_by_category(job_skills, skills, "language")) == top(expected, 15)
    assert tuples(analytics.skills_by_category(job_skills, skills, "none")) == []


@pytest.mark.parametrize("chosen", [["scripting"], ["scripting", "cloud"], ["none"], []])
def test_tag_cooccurrence(job_skills, skills, data, chosen):
    expected = defaultdict(set)
    for job, skill in data:
        tags = next(s[3] for s in SKILLS if s[0] == skill) or []
        if set(tags) & set(chosen):
            for tag in tags:
                if tag is not None and tag not in chosen:
                    expected[tag].add(job)
    got = analytics.tag_cooccurrence(job_skills, skills, chosen)
    assert got.columns == ["tag", "co_occurrence_count"]
    assert tuples(got) == top(expected, 20)


def test_metadata_and_status(frame):
    jobs = frame(
        [("1", "2024-01-01 10:20:30"), ("2", "2024-01-02 10:20:30"), ("3", None)],
        "job_id string, t string",
    ).select("job_id", F.col("t").cast("timestamp_ntz").alias("skill_extraction_date"))
    meta = analytics.metadata(jobs)
    assert meta.first().total_jobs == 2
    assert tuples(analytics.status_line(meta, "X")) == [
        (2, "2024-01-02 10:20",
         "Data source: X | Jobs ingested: 2 | Last ingestion: 2024-01-02 10:20")
    ]
    none = analytics.status_line(analytics.metadata(jobs.filter("job_id = '3'")), "X")
    assert tuples(none)[0][:2] == (0, "Never")


def test_hierarchy_and_median(job_skills, data):
    counts = analytics.skill_counts(job_skills)
    rows = tuples(analytics.skill_hierarchy(counts))
    assert rows[0] == ("Skills", "", 1)
    assert sorted(rows[1:]) == sorted((n, "Skills", len(j)) for n, j in by_name(data).items())
    assert analytics.median_count(counts).first()[0] == median(
        len(j) for j in by_name(data).values()
    )


def test_median_interpolates(frame):
    counts = frame([(1,), (2,), (3,), (10,)], "job_count long")
    assert analytics.median_count(counts).first()[0] == 2.5


def test_bottom_up(job_skills):
    best = analytics.top_skills(job_skills, 4)
    turned = analytics.bottom_up(best, "skill_name", "job_count")
    assert tuples(turned) == tuples(best)[::-1]
