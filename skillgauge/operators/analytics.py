"""Demand questions over the stored ``jobs``, ``skills`` and ``job_skills``.

Counts tie-break by name, so every top list is repeatable. Values given by the
caller enter as literals, never as query text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.operators.joins import lookup_join

# How many rows each report shows.
TOP_SKILLS = 10
TOP_RELATED = 15
TOP_TAGS = 20


def metadata(jobs: DataFrame) -> DataFrame:
    """One row: ``total_jobs`` processed and the time of the last extraction."""
    return jobs.filter(F.col("skill_extraction_date").isNotNull()).agg(
        F.countDistinct("job_id").alias("total_jobs"),
        F.max("skill_extraction_date").alias("last_ingestion"),
    )


def status_line(meta: DataFrame, label: str) -> DataFrame:
    """The metadata row as one line of text."""
    when = F.coalesce(
        F.date_format("last_ingestion", "yyyy-MM-dd HH:mm"), F.lit("Never")
    )
    return meta.select(
        "total_jobs",
        when.alias("last_ingestion"),
        F.concat(
            F.lit(f"Data source: {label} | Jobs ingested: "),
            F.col("total_jobs").cast("string"),
            F.lit(" | Last ingestion: "),
            when,
        ).alias("status"),
    )


def _in_order(name: str, collation: str | None) -> Column:
    return F.col(name) if collation is None else F.collate(F.col(name), collation)


def _by_demand(counts: DataFrame, name: str, count: str) -> DataFrame:
    return counts.orderBy(F.desc(count), F.asc(name))


def jobs_per_skill(pairs: DataFrame) -> DataFrame:
    """Number of jobs that ask for each skill, in no order.

    Distinct counting shuffles by (skill, job) and then adds up partial counts, so
    a skill that most jobs ask for is no hot spot.
    """
    return pairs.groupBy("skill_name").agg(
        F.countDistinct("job_id").alias("job_count")
    )


def skill_counts(job_skills: DataFrame) -> DataFrame:
    """Every skill with the number of jobs that ask for it, most wanted first."""
    return _by_demand(jobs_per_skill(job_skills), "skill_name", "job_count")


def top_skills(job_skills: DataFrame, limit: int = TOP_SKILLS) -> DataFrame:
    return skill_counts(job_skills).limit(limit)


def all_skills(job_skills: DataFrame, collation: str | None = None) -> DataFrame:
    """Names that occur in pairs. Order is by code point unless a collation is
    named."""
    names = job_skills.select("skill_name").distinct()
    return names.orderBy(_in_order("skill_name", collation))


def all_categories(skills: DataFrame, collation: str | None = None) -> DataFrame:
    names = skills.filter(F.col("category").isNotNull()).select("category").distinct()
    return names.orderBy(_in_order("category", collation))


def all_tags(skills: DataFrame) -> DataFrame:
    return skills.select(F.explode("tags").alias("tag")).distinct().orderBy("tag")


def cooccurring_skills(
    job_skills: DataFrame, skill: str, limit: int = TOP_RELATED
) -> DataFrame:
    """Other skills of the jobs that ask for ``skill``.

    A semi join keeps each pair once; a self join would first repeat it.
    """
    holders = job_skills.filter(F.col("skill_name") == skill).select("job_id")
    others = job_skills.filter(F.col("skill_name") != skill).join(
        holders, "job_id", "left_semi"
    )
    return skill_counts(others).limit(limit)


def skills_by_category(
    job_skills: DataFrame, skills: DataFrame, category: str, limit: int = TOP_RELATED
) -> DataFrame:
    """Demand for the skills of one category."""
    chosen = skills.filter(F.col("category") == category).select("skill_id")
    pairs = lookup_join(
        job_skills.select("job_id", "skill_id", "skill_name"),
        chosen,
        ["skill_id"],
        "inner",
        ["job_id"],
    )
    return skill_counts(pairs).limit(limit)


def tag_cooccurrence(
    job_skills: DataFrame, skills: DataFrame, tags: list[str], limit: int = TOP_TAGS
) -> DataFrame:
    """Other tags of the skills that carry one of ``tags``, by number of jobs.

    Tags are those of the same skill, not of other skills of the job. The
    catalog is cut down before it meets the pairs.
    """
    wanted = F.array(*[F.lit(tag) for tag in tags]).cast("array<string>")
    other = skills.filter(F.arrays_overlap("tags", wanted)).select(
        "skill_id", F.array_compact(F.array_except("tags", wanted)).alias("tags")
    )
    tagged = lookup_join(
        job_skills.select("job_id", "skill_id"), other, ["skill_id"], "inner", ["job_id"]
    ).select("job_id", F.explode("tags").alias("tag"))
    counts = tagged.groupBy("tag").agg(
        F.countDistinct("job_id").alias("co_occurrence_count")
    )
    return _by_demand(counts, "tag", "co_occurrence_count").limit(limit)


# The root of the demand hierarchy and its small own weight.
HIERARCHY_ROOT = "Skills"
HIERARCHY_ROOT_VALUE = 1


def skill_hierarchy(counts: DataFrame) -> DataFrame:
    """Rows (label, parent, value): a root and one child per skill."""
    spark = counts.sparkSession
    root = spark.range(1).select(
        F.lit(HIERARCHY_ROOT).alias("label"),
        F.lit("").alias("parent"),
        F.lit(HIERARCHY_ROOT_VALUE).cast("long").alias("value"),
    )
    children = counts.select(
        F.col("skill_name").alias("label"),
        F.lit(HIERARCHY_ROOT).alias("parent"),
        F.col("job_count").alias("value"),
    )
    return root.unionByName(children)


def median_count(counts: DataFrame) -> DataFrame:
    """Exact median of the job counts, one value per catalog skill."""
    return counts.agg(F.median("job_count").alias("median_count"))


def bottom_up(top: DataFrame, name: str, count: str) -> DataFrame:
    """A top list in reverse, as a bar chart stacks it."""
    return top.orderBy(F.asc(count), F.desc(name))
