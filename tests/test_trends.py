import math
import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

from pyspark.sql import functions as F

from skillgauge.operators import trends

NOW = "2024-03-01 00:00:00"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def log(frame, n=500):
    rng = random.Random(7)
    start = date(2024, 1, 1)
    rows = [
        (rng.choice("ab"), str(start + timedelta(days=rng.choice([0, 1, 2, 5, 9, 20]))))
        for _ in range(n)
    ]
    df = frame(rows, "package_id string, d string")
    return rows, df.select("package_id", F.col("d").cast("timestamp_ntz").alias("ts"))


def test_daily_and_repeated_load(frame):
    rows, events = log(frame)
    daily = trends.daily_downloads(events, F.lit(NOW))
    got = {(r.package_id, str(r.date)): r.downloads for r in daily.collect()}
    assert got == Counter(rows)
    assert daily.select("download_id").distinct().count() == len(got)
    later = daily.filter("package_id = 'a'").withColumns(
        {"downloads": F.lit(1), "created_at": F.lit("2024-04-01").cast("timestamp_ntz")}
    )
    once = trends.load_downloads(daily, later)
    assert once.columns == daily.columns
    assert tuples(trends.load_downloads(once, later)) == tuples(once)
    kept = {(r.package_id, str(r.date)): r.downloads for r in once.collect()}
    assert kept == {k: (1 if k[0] == "a" else n) for k, n in got.items()}


def test_rolling(frame):
    rows, events = log(frame)
    counts = Counter(rows)
    result = trends.rolling_downloads(trends.daily_downloads(events, F.lit(NOW)), 3)
    for r in result.collect():
        days = [str(r.date - timedelta(days=i)) for i in range(3)]
        assert r.rolling == sum(counts[r.package_id, d] for d in days)
        earlier = [d for p, d in counts if p == r.package_id and d < str(r.date)]
        if earlier:
            assert r.change == r.downloads - counts[r.package_id, max(earlier)]
        else:
            assert r.change is None


def test_by_category(frame):
    daily = frame([("a", 3), ("a", 4), ("b", 5), ("c", 9)], "package_id string, downloads int")
    packages = frame([("a", "x"), ("b", "x"), ("d", "y")], "package_id string, category string")
    assert tuples(trends.downloads_by_category(daily, packages)) == [("x", 12)]


def sample(frame):
    rng = random.Random(8)
    skills = ["SQL", "dbt", "Java", "Go"]
    jobs, pairs = [], []
    for i in range(80):
        day = None if i == 0 else str(date(2024, 1, 1) + timedelta(days=rng.randint(0, 60)))
        jobs.append((str(i), day, rng.choice(["ar", "cl"]), rng.choice(["c1", "c2"])))
        pairs += [(str(i), s) for s in skills if rng.random() < 0.4]
    jobs_df = frame(jobs, "job_id string, d string, country string, company_name string")
    jobs_df = jobs_df.withColumn("posted_date", F.col("d").cast("date"))
    return jobs, pairs, jobs_df, frame(pairs, "job_id string, skill_name string")


def test_demand_over_time(frame):
    jobs, pairs, jobs_df, pairs_df = sample(frame)
    day = {j[0]: j[1] for j in jobs}
    for period in ("week", "month"):
        expected = Counter()
        for job, skill in pairs:
            if day[job]:
                d = date.fromisoformat(day[job])
                first = d - timedelta(days=d.weekday()) if period == "week" else d.replace(day=1)
                expected[first, skill] += 1
        got = trends.demand_over_time(jobs_df, pairs_df, period)
        assert {(r[0], r[1]): r[2] for r in got.collect()} == expected


def test_lift(frame):
    jobs, pairs, jobs_df, pairs_df = sample(frame)
    holders = defaultdict(set)
    for job, skill in pairs:
        holders[skill].add(job)
    for r in trends.skill_lift(jobs_df, pairs_df, "SQL").collect():
        both = len(holders[r.skill_name] & holders["SQL"])
        assert r.job_count == both
        assert math.isclose(r.support, both / 80, abs_tol=1e-6)
        lift = both * 80 / len(holders[r.skill_name]) / len(holders["SQL"])
        assert math.isclose(r.lift, lift, abs_tol=1e-6)
    assert trends.skill_lift(jobs_df, pairs_df, "none").count() == 0


def test_filters(frame):
    jobs, pairs, jobs_df, pairs_df = sample(frame)

    def ids(**filters):
        return {r.job_id for r in trends.filter_jobs(jobs_df, pairs_df, **filters).collect()}

    assert len(ids()) == 80
    assert ids(countries=["ar"]) == {j[0] for j in jobs if j[2] == "ar"}
    asked = {job for job, skill in pairs if skill in ("Go", "dbt")}
    assert ids(skills=["Go", "dbt"]) == asked
    both = {j[0] for j in jobs if j[2] == "cl" and j[3] == "c1"} & asked
    assert ids(countries=["cl"], companies=["c1"], skills=["Go", "dbt"]) == both
    assert ids(skills=[]) == set()


def test_search(frame):
    rng = random.Random(9)
    words = ["alpha", "Beta", "beta-x", "gamma", "alphabet", "_beta"]
    texts = [" ".join(rng.choices(words, k=6)) for _ in range(200)] + [None]
    df = frame([(str(i), t) for i, t in enumerate(texts)], "job_id string, job_description string")
    counts = [Counter(re.findall(r"\w+", (t or "").lower())) for t in texts]
    idf = {w: math.log(len(texts) / sum(1 for c in counts if c[w])) for w in ("alpha", "beta")}
    expected = {
        str(i): sum(c[w] * idf[w] for w in idf) for i, c in enumerate(counts)
        if all(c[w] for w in idf)
    }
    got = {r.job_id: r.score for r in trends.search_jobs(df, ["BETA", "alpha"]).collect()}
    assert got.keys() == expected.keys() and len(got) > 50
    assert all(math.isclose(got[k], expected[k], abs_tol=1e-5) for k in got)
    assert trends.search_jobs(df, ["absent"]).count() == 0
