"""Reports kept up to date load by load: exact sets of jobs as bitmaps.

For each load and skill the jobs are a bitmap over job numbers, cut into pieces of 32,768
numbers. Bitmaps of loads are joined by OR, so a job that several loads give a skill
counts once, and a report after a new load reads that load and the bitmaps, not the
pairs of earlier loads.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.sources.tables import append_load, read_table, table_loads

BITMAPS = "skill_name string, piece long, jobs binary"


def skill_bitmaps(pairs: DataFrame, number: Column) -> DataFrame:
    """``skill_name``, ``piece``, ``jobs`` of pairs; ``number`` is a job's own whole
    number, not negative. Folded before the shuffle, so a hot skill does not move."""
    return pairs.groupBy("skill_name", F.bitmap_bucket_number(number).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("jobs")
    )


def update_bitmaps(
    spark: SparkSession, root: str, schema: str, number: Column, pairs: str = "job_skills", state: str = "skill_bitmaps"
) -> list[str]:
    """Bring the bitmaps up to date. Reads only loads that are new or were run again;
    returns their names."""
    known = {load.load_id: load.n_rows for load in table_loads(spark, root, f"{state}_of")}
    written = {load.load_id: load for load in table_loads(spark, root, pairs)}
    made = read_table(spark, root, f"{state}_of", "attempt string").collect() if known else []
    attempts = {row.load_id: row.attempt for row in made}
    changed = [name for name, load in written.items() if attempts.get(name) != load.attempt]
    for name in changed:
        rows = read_table(spark, root, pairs, schema, only=[name])
        append_load(skill_bitmaps(rows, number), root, state, name)
        note = spark.createDataFrame([(written[name].attempt,)], "attempt string")
        append_load(note, root, f"{state}_of", name)
    return changed


def bitmap_counts(spark: SparkSession, root: str, state: str = "skill_bitmaps") -> DataFrame:
    """``skill_name`` and ``job_count``, its distinct jobs over all loads."""
    pieces = read_table(spark, root, state, BITMAPS).groupBy("skill_name", "piece").agg(
        F.bitmap_or_agg("jobs").alias("jobs")
    )
    return pieces.groupBy("skill_name").agg(F.sum(F.bitmap_count("jobs")).alias("job_count"))


def top_skills(spark: SparkSession, root: str, limit: int = 10, state: str = "skill_bitmaps") -> DataFrame:
    """The skills that most jobs ask for, as ``analytics.top_skills`` gives them."""
    return bitmap_counts(spark, root, state).orderBy(F.desc("job_count"), "skill_name").limit(limit)
