"""The steps from saved pages to stored pairs.

Each step writes its result below ``root`` under the stamp it is given, so a step
can be run again with the same stamp, and a later step never repeats the work of
an earlier one. Counts are returned as one-row DataFrames. They are taken by the tasks
that write a result, never before a shuffle, so that nothing is read again for them and
a task that is run again counts once.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skillgauge import schemas
from skillgauge.operators.catalog import upsert_catalog
from skillgauge.operators.extract import SOURCE, parse_postings, split_errors
from skillgauge.operators.match import match_pairs, unprocessed
from skillgauge.operators.merge import (
    INSERTED,
    absent_rows,
    as_unprocessed,
    dedup,
    pair_status,
    pairs_to_insert,
)
from skillgauge.operators.quality import row_errors, status_counts, stored_values
from skillgauge.session import spread
from skillgauge.sources.files import (
    read_export,
    read_pages,
    write_counted_export,
    write_export,
)
from skillgauge.sources.pages import consume_folder
from skillgauge.sources.keys import known_keys
from skillgauge.sources.tables import append_keyed_load, append_load, read_loads, read_table, table_loads


def _counts(spark: SparkSession, **counts: int) -> DataFrame:
    schema = ", ".join(f"{name} long" for name in counts)
    return spark.createDataFrame([tuple(counts.values())], schema)


def parse_folder(
    spark: SparkSession, folder: str, root: str, stamp: str, source: str = SOURCE
) -> DataFrame:
    """Saved pages -> jobs export. Returns files, saved, duplicates, failed."""
    return parse_pages(spread(read_pages(spark, folder)), root, stamp, source)


def parse_pages(
    pages: DataFrame,
    root: str,
    stamp: str,
    source: str = SOURCE,
    exports: str = "exports/jobs",
) -> DataFrame:
    spark, parsed_path = pages.sparkSession, f"{root}/parsed/run={stamp}"
    seen = Observation()
    failed = F.count("error_reason").alias("failed")
    parsed = parse_postings(pages, source).observe(seen, F.count(F.lit(1)).alias("files"), failed)
    parsed.write.mode("overwrite").parquet(parsed_path)
    good, _ = split_errors(spark.read.schema(parsed.schema).parquet(parsed_path))
    first = dedup(good, ["job_source_id"], ["file_name"]).drop("file_name")
    _, saved = write_counted_export(first, f"{root}/{exports}", stamp)
    files, failed = seen.get["files"], seen.get["failed"]
    return _counts(spark, files=files, saved=saved, duplicates=files - failed - saved, failed=failed)


def consume_pages(
    spark: SparkSession, folder: str, root: str, stamp: str, now: Column, source: str = SOURCE
) -> DataFrame:
    """New pages of a folder -> ``jobs``, each file once; files that were read are moved
    to ``<folder>_processed/<stamp>``. Returns files, moved."""

    def take(run: str, pages: DataFrame) -> None:
        parse_pages(spread(pages), root, run, source)
        load_jobs(spark, root, run, now)

    consume_folder(spark, folder, root, stamp, take)
    moves = read_loads(spark, root, "moved_files", "file_path string, status string", [stamp])
    return moves.agg(F.count("*").alias("files"), F.count_if(F.col("status") == "moved").alias("moved"))


def load_jobs(
    spark: SparkSession, root: str, stamp: str, now: Column, export: str | None = None
) -> DataFrame:
    """Jobs export ``export``, by default the one named ``stamp`` -> ``jobs``. Returns
    inserted, failed, total; rows that break a rule are kept in ``rejected_jobs``. Fails
    if there is no such export; ``files.latest_stamp`` names the newest."""
    rows = read_export(spark, f"{root}/exports/jobs", schemas.JOBS_EXPORT, export or stamp)
    return merge_jobs(rows, root, stamp, now)


def merge_jobs(export: DataFrame, root: str, stamp: str, now: Column) -> DataFrame:
    checked = row_errors(export, schemas.JOBS_WIDTHS, dates=["posted_date"])
    good, _ = split_errors(checked)
    rows = stored_values(good, schemas.JOBS_WIDTHS, dates=["posted_date"])
    known = known_keys(rows, root, "jobs", schemas.JOBS_KEY, but=stamp)
    new = absent_rows(rows, known, schemas.JOBS_KEY, rows.columns, id_name="job_id", load=stamp)
    inserted = append_keyed_load(as_unprocessed(new, now), root, "jobs", stamp, schemas.JOBS_KEY)
    return _with_rejected(checked, root, "rejected_jobs", stamp, inserted)


def _with_rejected(checked: DataFrame, root: str, table: str, stamp: str, inserted: int) -> DataFrame:
    """Keep the rejected rows. Returns inserted, failed, total."""
    seen = Observation()
    _, bad = split_errors(checked.observe(seen, F.count(F.lit(1)).alias("total")))
    failed = append_load(bad, root, table, stamp)
    return _counts(checked.sparkSession, inserted=inserted, failed=failed, total=seen.get["total"])


def merge_legacy_jobs(
    records: DataFrame, root: str, stamp: str, now: Column
) -> DataFrame:
    """Records of the selector and listing readers -> ``legacy_jobs``, one per
    address. Returns inserted, failed, total."""
    spark = records.sparkSession
    if "scraped_date" not in records.columns:
        records = records.withColumn("scraped_date", now.cast("date"))
    made = {"job_id", "created_at", "updated_at"}
    table = spark.createDataFrame([], schemas.LEGACY_JOBS)
    rows = records.select(*[c for c in table.columns if c not in made])
    checked = row_errors(
        rows, schemas.LEGACY_JOBS_WIDTHS, required=schemas.LEGACY_JOBS_REQUIRED
    )
    good, _ = split_errors(checked)
    good = stored_values(good, schemas.LEGACY_JOBS_WIDTHS)
    known = known_keys(good, root, "legacy_jobs", schemas.LEGACY_JOBS_KEY, but=stamp)
    new = absent_rows(
        good, known, schemas.LEGACY_JOBS_KEY, good.columns, id_name="job_id", load=stamp
    )
    at = now.cast("timestamp_ntz")
    stored = new.withColumns({"created_at": at, "updated_at": at})
    inserted = append_keyed_load(
        stored.select(*table.columns), root, "legacy_jobs", stamp, schemas.LEGACY_JOBS_KEY
    )
    return _with_rejected(checked, root, "rejected_legacy_jobs", stamp, inserted)


def load_catalog(batch: DataFrame, root: str, stamp: str, now: Column) -> DataFrame:
    """Upsert into ``skills``: each load is a whole new version. Returns inserted, failed,
    total; rows without a name, or with one too long, are kept in ``rejected_skills``.

    A load that is run again starts from the version before it, as it did at first.
    """
    spark = batch.sparkSession
    checked = row_errors(batch, schemas.SKILLS_WIDTHS, required=["skill_name"])
    good, _ = split_errors(checked)
    rows = stored_values(good, {c: w for c, w in schemas.SKILLS_WIDTHS.items() if c in batch.columns})
    target = _catalog_before(spark, root, stamp)
    append_load(upsert_catalog(target, rows, now), root, "skills", stamp)
    summary = _with_rejected(checked, root, "rejected_skills", stamp, 0)
    return summary.withColumn("inserted", F.col("total") - F.col("failed"))


def _catalog_before(spark: SparkSession, root: str, stamp: str | None = None) -> DataFrame:
    """The version that the load before ``stamp`` made; the newest if it is new."""
    loads = [load.load_id for load in table_loads(spark, root, "skills")]
    loads = loads[: loads.index(stamp)] if stamp in loads else loads
    return read_loads(spark, root, "skills", schemas.SKILLS, loads[-1:]).drop("load_id")


def current_catalog(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of the catalog: the one of the load made last."""
    return _catalog_before(spark, root)


def current_jobs(spark: SparkSession, root: str) -> DataFrame:
    """``jobs`` with the time of their skill extraction."""
    marks = (
        read_table(spark, root, "job_marks", schemas.JOB_MARKS)
        .groupBy("job_id")
        .agg(F.max("skill_extraction_date").alias("skill_extraction_date"))
    )
    jobs = read_table(spark, root, "jobs", schemas.JOBS)
    columns = [c for c in jobs.columns if c != "load_id"]
    return (
        jobs.drop("skill_extraction_date").join(marks, "job_id", "left").select(*columns)
    )


def _marked_ids(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "job_marks", schemas.JOB_MARKS).select("job_id")


def open_jobs(spark: SparkSession, root: str) -> DataFrame:
    """Jobs to scan for skills.

    Ids alone tell how far each load is done. A finished load is not read, a new
    one is read as it is, and only the texts of a partly done load meet the marks
    in a join.
    """
    marks = _marked_ids(spark, root)
    ids = read_table(spark, root, "jobs", schemas.JOBS).select("job_id", "load_id")
    progress = (
        ids.join(marks.distinct().withColumn("done", F.lit(True)), "job_id", "left")
        .groupBy("load_id")
        .agg(
            F.count_if(F.col("done").isNull()).alias("waiting"),
            F.count_if("done").alias("done"),
        )
        .filter("waiting > 0")
        .collect()  # one row per load that was ever made
    )

    def texts(loads):
        return unprocessed(spread(read_loads(spark, root, "jobs", schemas.JOBS, loads)))

    new = texts([load.load_id for load in progress if load.done == 0])
    partly = [load.load_id for load in progress if load.done > 0]
    if not partly:
        return new
    return new.unionByName(texts(partly).join(marks, "job_id", "left_anti"))


def extract_pairs(
    spark: SparkSession, root: str, stamp: str, match_variants: bool = False
) -> str:
    """Open jobs x catalog -> pairs export. Returns its path. The ids of the jobs
    that are scanned are kept beside it."""
    ids = read_table(spark, root, "jobs", schemas.JOBS).select("job_id")
    waiting = ids.join(_marked_ids(spark, root), "job_id", "left_anti")
    write_export(waiting, f"{root}/exports/scanned", stamp)
    pairs = match_pairs(
        open_jobs(spark, root), current_catalog(spark, root), match_variants
    )
    return write_export(pairs, f"{root}/exports/pairs", stamp)


def load_pairs(
    spark: SparkSession, root: str, stamp: str, now: Column, mark: str = "inserted", export: str | None = None
) -> DataFrame:
    """Pairs export ``export``, by default the one named ``stamp`` -> ``job_skills`` and
    marks. Returns inserted, duplicates, failed, total.

    ``mark="inserted"`` marks jobs that got a new pair; ``mark="scanned"`` marks
    every job that was scanned, so that jobs without skills are not read again.
    """
    exports, chosen = f"{root}/exports", export or stamp
    pairs = read_export(spark, f"{exports}/pairs", schemas.PAIRS_EXPORT, chosen)
    jobs = read_table(spark, root, "jobs", schemas.JOBS)
    stored = read_table(spark, root, "job_skills", schemas.JOB_SKILLS, but=stamp)
    status_path = f"{root}/pair_status/run={stamp}"
    seen = Observation()
    status = pair_status(pairs, current_catalog(spark, root), jobs, stored)
    status = status.observe(seen, *status_counts())
    status.write.mode("overwrite").parquet(status_path)
    status = spark.read.schema(status.schema).parquet(status_path)
    append_load(pairs_to_insert(status, now), root, "job_skills", stamp)

    if mark == "scanned":
        done = read_export(spark, f"{exports}/scanned", "job_id string", chosen)
    else:
        done = status.filter(F.col("status") == INSERTED)
    marks = (
        done.select("job_id")
        .distinct()
        .withColumn("skill_extraction_date", now.cast("timestamp_ntz"))
    )
    append_load(marks, root, "job_marks", stamp)
    return _counts(spark, **{name: seen.get[name] for name in ("inserted", "duplicates", "failed", "total")})
