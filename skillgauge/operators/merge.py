"""Keyed loading: first-wins dedup, insert-if-absent, pair loading, marks, and
cascading deletes.

A key may be shared by any number of rows, so copies are folded by aggregates,
which combine before the shuffle, and never by a window over one key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.ids import stable_id
from skillgauge.operators.joins import lookup_join
from skillgauge.schemas import JOB_SKILLS_WIDTHS

_ROW = "_row"
_OPEN = "_open_key"


def _open_key(keys: list[str], order: list[str]) -> Column:
    """Empty for a complete key. A key with a null equals no other key, so such a row
    gets a value of its own content, which also keeps these rows apart in shuffles."""
    partial = F.lit(False)
    for key in keys:
        partial = partial | F.col(key).isNull()
    return F.when(partial, stable_id(*[F.col(c) for c in order])).otherwise("")


def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, with ``copies``, the number of rows
    that had the key. ``order`` must tell rows of one key apart."""
    rest = [c for c in batch.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in [*order, *[r for r in rest if r not in order]]])
    folded = (
        batch.withColumn(_OPEN, _open_key(keys, order))
        .groupBy(*keys, _OPEN)
        .agg(F.min(row).alias(_ROW), F.count("*").alias("copies"))
    )
    return folded.select(
        *[
            F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c)
            for c in batch.columns
        ],
        "copies",
        _OPEN,
    )


def _all_open_rows(first: DataFrame) -> DataFrame:
    """Equal rows without a complete key were folded as well: repeat them, each
    with a number in its open key."""
    last = F.when(F.col(_OPEN) == "", 1).otherwise(F.col("copies").cast("int"))
    numbered = first.withColumn("_no", F.explode(F.sequence(F.lit(1), last)))
    key = F.when(F.col(_OPEN) == "", "").otherwise(F.concat_ws("-", _OPEN, "_no"))
    return numbered.withColumn(_OPEN, key).drop("_no", "copies")


def dedup(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, and every row whose key holds a
    null."""
    return _all_open_rows(first_per_key(batch, keys, order)).drop(_OPEN)


def absent_rows(
    batch: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[str],
    id_name: str | None = None,
    load: str = "",
) -> DataFrame:
    """Rows of the batch that insert-if-absent would add to the target.

    The fold and the anti join share one shuffle of the batch. Of the target
    only the key columns are read. ``id_name`` adds an id made from the key. A row
    whose key holds a null has the id of its content, its number among equal rows and
    ``load``, so ids differ over all loads and come out the same when a load is run
    again.
    """
    # Always empty, but not a constant: the optimizer would take a constant out of
    # the join key, and rows with a null in their key would all meet in one task.
    complete = F.substring(F.col(keys[0]).cast("string"), 1, 0)
    known = target.select(*keys).dropna(how="any").withColumn(_OPEN, complete)
    first = first_per_key(batch, keys, order)
    new = _all_open_rows(first.join(known, [*keys, _OPEN], "left_anti"))
    own = F.when(F.col(_OPEN) == "", "").otherwise(F.concat_ws("-", _OPEN, F.lit(load)))
    made = stable_id(*[F.col(k) for k in keys], own)
    ids = [] if id_name is None else [made.alias(id_name)]
    return new.select(*ids, *batch.columns)


def as_unprocessed(rows: DataFrame, now: Column) -> DataFrame:
    """New job rows with their creation time and no mark."""
    return rows.withColumns(
        {
            "created_at": now.cast("timestamp_ntz"),
            "skill_extraction_date": F.lit(None).cast("timestamp_ntz"),
        }
    )


INSERTED, DUPLICATE, FAILED = "inserted", "duplicate", "failed"


def pair_status(
    pairs: DataFrame, skills: DataFrame, jobs: DataFrame, job_skills: DataFrame
) -> DataFrame:
    """What loading each distinct pair does.

    One row per (job_id, skill_name, status) with ``n_rows``, the number of
    input rows it stands for: a new pair that came three times gives one row
    ``inserted`` with 1 and one row ``duplicate`` with 2. A pair fails if its
    skill or its job is unknown, or if its title does not fit the column.
    """
    folded = pairs.groupBy("job_id", "skill_name").agg(
        F.min("job_title").alias("job_title"), F.count("*").alias("n_rows")
    )
    named = lookup_join(
        folded,
        skills.select("skill_name", "skill_id"),
        ["skill_name"],
        "left",
        ["job_id"],
    )
    # A job has at most one row per skill here, so these keys are even.
    known_jobs = jobs.select("job_id").distinct().withColumn("_job", F.lit(True))
    known = named.join(known_jobs, "job_id", "left")
    pair = ["job_id", "skill_id"]
    stored = job_skills.select(*pair).distinct().withColumn("_pair", F.lit(True))
    seen = known.join(stored, pair, "left")
    one = F.lit(1).cast("long")

    def outcome(status, n_rows):
        return F.struct(F.lit(status).alias("status"), n_rows.alias("n_rows"))

    outcomes = (
        F.when(
            F.col("skill_id").isNull()
            | F.col("_job").isNull()
            | (F.length(F.rtrim("job_title")) > JOB_SKILLS_WIDTHS["job_title"]),
            F.array(outcome(FAILED, F.col("n_rows"))),
        )
        .when(F.col("_pair"), F.array(outcome(DUPLICATE, F.col("n_rows"))))
        .when(
            F.col("n_rows") > 1,
            F.array(
                outcome(INSERTED, one), outcome(DUPLICATE, F.col("n_rows") - one)
            ),
        )
        .otherwise(F.array(outcome(INSERTED, one)))
    )
    return seen.select(
        "job_id", "job_title", "skill_id", "skill_name", F.inline(outcomes)
    )


def pairs_to_insert(status: DataFrame, now: Column, method: str = "regex") -> DataFrame:
    """Table rows of the new pairs."""
    return status.filter(F.col("status") == INSERTED).select(
        stable_id(F.col("job_id"), F.col("skill_id")).alias("job_skill_id"),
        "job_id",
        "job_title",
        "skill_id",
        "skill_name",
        F.lit(method).alias("extraction_method"),
        now.cast("timestamp_ntz").alias("created_at"),
    )


def mark_processed(jobs: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """Jobs with the extraction time set to ``now`` where ``done`` has the job."""
    hits = done.select("job_id").distinct().withColumn("_hit", F.lit(True))
    return (
        jobs.join(hits, "job_id", "left")
        .withColumn(
            "skill_extraction_date",
            F.when(F.col("_hit"), now.cast("timestamp_ntz")).otherwise(
                F.col("skill_extraction_date")
            ),
        )
        .select(*jobs.columns)
    )


def cascade_delete(
    children: DataFrame, deleted: DataFrame, key: str, salt_by: list[str]
) -> DataFrame:
    """Child rows left after the parents in ``deleted`` are gone."""
    gone = deleted.select(key).dropna().distinct()
    return lookup_join(children, gone, [key], "left_anti", salt_by, read_twice=True)


def orphans(
    children: DataFrame, parents: DataFrame, key: str, salt_by: list[str]
) -> DataFrame:
    """Child rows whose parent is missing."""
    return lookup_join(
        children.filter(F.col(key).isNotNull()),
        parents.select(key),
        [key],
        "left_anti",
        salt_by,
        read_twice=True,
    )
