"""Demand over time, download series, and job selection."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.functions.ids import stable_id
from skillgauge.operators.match import build_pattern


def daily_downloads(events: DataFrame, now: Column) -> DataFrame:
    """Raw download records (package_id, ts) folded to one row per package and
    day. Partial counts are combined before the shuffle."""
    days = events.groupBy("package_id", F.to_date("ts").alias("date")).agg(
        F.count("*").alias("downloads")
    )
    return days.select(
        stable_id(F.col("package_id"), F.col("date")).alias("download_id"),
        "*",
        now.cast("timestamp_ntz").alias("created_at"),
    )


def load_downloads(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Series after a load that may be repeated: one row per package and day,
    and the batch replaces what it states again."""
    keys = ["package_id", "date"]
    payload = [c for c in target.columns if c not in keys]
    rows = target.withColumn("_new", F.lit(0)).unionByName(
        batch.select(*target.columns).withColumn("_new", F.lit(1))
    )
    newest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct("_new", "created_at", "downloads")).alias("v")
    )
    return newest.select(*keys, "v.*").select(*target.columns)


def rolling_downloads(downloads: DataFrame, days: int = 7) -> DataFrame:
    """Each day with the total of the last ``days`` days and the change against
    the day before in the series. A package has one row per day."""
    by_day = Window.partitionBy("package_id").orderBy("date")
    day_no = F.datediff("date", F.lit("1970-01-01").cast("date"))
    last = Window.partitionBy("package_id").orderBy(day_no).rangeBetween(1 - days, 0)
    return downloads.select(
        "package_id",
        "date",
        "downloads",
        F.sum("downloads").over(last).alias("rolling"),
        (F.col("downloads") - F.lag("downloads").over(by_day)).alias("change"),
    )


def downloads_by_category(downloads: DataFrame, packages: DataFrame) -> DataFrame:
    totals = downloads.groupBy("package_id").agg(F.sum("downloads").alias("n"))
    named = totals.join(packages.select("package_id", "category"), "package_id")
    return named.groupBy("category").agg(F.sum("n").alias("downloads"))


def demand_over_time(
    jobs: DataFrame, job_skills: DataFrame, period: str = "week"
) -> DataFrame:
    """Jobs per skill and posting period. Jobs without a date are left out, as
    they belong to no period."""
    dated = jobs.filter(F.col("posted_date").isNotNull()).select(
        "job_id", F.trunc("posted_date", period).alias("period_start")
    )
    pairs = job_skills.select("job_id", "skill_name").join(dated, "job_id")
    return pairs.groupBy("period_start", "skill_name").agg(
        F.countDistinct("job_id").alias("job_count")
    )


def skill_lift(jobs: DataFrame, job_skills: DataFrame, skill: str) -> DataFrame:
    """For every other skill: jobs with both, support, and lift against
    ``skill``. One chosen skill at a time, so no pair of skills is built."""
    total = jobs.agg(F.count("*").alias("n_jobs"))
    flagged = job_skills.select("job_id", "skill_name").join(
        job_skills.filter(F.col("skill_name") == skill)
        .select("job_id", F.lit(True).alias("_with"))
        .distinct(),
        "job_id",
        "left",
    )
    each = flagged.groupBy("skill_name").agg(
        F.countDistinct("job_id").alias("n_skill"),
        F.countDistinct(F.when(F.col("_with"), F.col("job_id"))).alias("n_both"),
    )
    # Single-row frames, read once as scalar subqueries.
    n_jobs = total.scalar()
    chosen = job_skills.filter(F.col("skill_name") == skill)
    n_chosen = chosen.agg(F.countDistinct("job_id").alias("n")).scalar()
    return each.filter(
        (F.col("skill_name") != skill) & (F.col("n_both") > 0)
    ).select(
        "skill_name",
        F.col("n_both").alias("job_count"),
        F.round(F.col("n_both") / n_jobs, 6).alias("support"),
        F.round(
            (F.col("n_both").cast("double") * n_jobs) / (F.col("n_skill") * n_chosen), 6
        ).alias("lift"),
    )


def filter_jobs(
    jobs: DataFrame,
    job_skills: DataFrame | None = None,
    countries: list[str] | None = None,
    companies: list[str] | None = None,
    skills: list[str] | None = None,
) -> DataFrame:
    """Jobs in one of the countries, of one of the companies, and asking for at
    least one of the skills. A filter that is not given selects everything."""
    if countries is not None:
        jobs = jobs.filter(F.col("country").isin(countries))
    if companies is not None:
        jobs = jobs.filter(F.col("company_name").isin(companies))
    if skills is not None:
        asked = job_skills.filter(F.col("skill_name").isin(skills)).select("job_id")
        jobs = jobs.join(asked, "job_id", "left_semi")
    return jobs


def search_jobs(jobs: DataFrame, words: list[str]) -> DataFrame:
    """Jobs whose description holds every word, with a relevance score.

    The score adds, per word, its number of occurrences times
    ``ln(jobs / jobs with the word)``. Without words nothing is found.
    """
    words = sorted({word.lower() for word in words if word})
    if not words:
        jobs = jobs.where(F.lit(False))
    counted = jobs.select(
        "job_id",
        F.array(
            *[
                F.regexp_count("job_description", F.lit(build_pattern([word])))
                for word in words
            ]
        ).alias("hits"),
    )
    each = range(len(words))
    weights = counted.agg(
        F.array(
            *[
                F.ln(F.count("*") / F.nullif(F.count_if(F.col("hits")[i] > 0), F.lit(0)))
                for i in each
            ]
        ).alias("w")
    ).scalar()
    score = F.aggregate(
        F.zip_with("hits", "weights", lambda n, w: n * w), F.lit(0.0), lambda s, x: s + x
    )
    # Exploding zero or one score keeps the counting in one place; a filter on the
    # counts would be moved down and count a second time.
    found = F.when(F.forall("hits", lambda n: n > 0), F.array(F.round(score, 6)))
    return counted.withColumn("weights", weights).select(
        "job_id", F.explode(found).alias("score")
    )
