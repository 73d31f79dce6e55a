"""Support and lift of all pairs of skills, from one count matrix a task.

Each task counts its own jobs in a matrix over the catalog, so what is shuffled depends
on the catalog and the number of tasks, never on the number of jobs or on how many
skills a job has. There is no join of pairs with themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest catalog: a task's matrix then takes 128 MB.
CATALOG = 4096
_ROWS = 2048

COUNTS = "a int, b int, n long"


def count_matrix(sets: pa.Array, names: pa.Array, total: np.ndarray) -> None:
    """Add the pairs of each list of names to ``total``, each name once a list."""
    lists = sets.fill_null([])
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    code = pc.index_in(lists.flatten(), value_set=names)
    known = code.is_valid().to_numpy(zero_copy_only=False)
    row, code = row[known], code.drop_null().to_numpy()
    has = np.zeros((len(lists), len(names)), np.float32)
    has[row, code] = 1
    total += (has.T @ has).astype(np.int64)


def pair_counts(sets: DataFrame, names: list[str]) -> DataFrame:
    """``a``, ``b``, ``n``: jobs with the names numbered a <= b; a = b counts one name.
    The row -1, -1 counts all jobs. ``sets`` has one column, an array of names."""
    if len(names) > CATALOG:
        raise ValueError(f"a count matrix takes at most {CATALOG} names")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((len(names), len(names)), np.int64), 0
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                count_matrix(batch.column(0).slice(first, _ROWS), pa.array(names, pa.string()), total)
            n += batch.num_rows
        a, b = np.nonzero(np.triu(total))
        columns = [np.append(a, -1).astype(np.int32), np.append(b, -1).astype(np.int32), np.append(total[a, b], n)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n"])

    return sets.mapInArrow(count, COUNTS).groupBy("a", "b").agg(F.sum("n").alias("n"))


def frequent_pairs(sets: DataFrame, names: list[str], min_support: float, path: str) -> DataFrame:
    """Pairs of names that at least ``min_support`` of all jobs hold: ``skill_a`` before
    ``skill_b`` by code point, ``job_count``, ``support``, ``lift``. The counts are kept
    at ``path``, so that the jobs are read once."""
    names = sorted(set(names))
    pair_counts(sets, names).write.parquet(path)
    counts = sets.sparkSession.read.parquet(path)
    # One row for each name of the catalog, and one for all jobs.
    singles = counts.where("a = b").select("a", F.col("n").alias("single"))
    label = F.element_at(F.lit(names), F.col("a") + 1) if names else F.lit(None).cast("string")
    named = singles.where("a >= 0").select("a", label.alias("name"), "single")
    whole = singles.where("a < 0").select(F.col("single").alias("jobs"), F.lit(1).alias("one"))
    left = named.select("a", F.col("name").alias("skill_a"), F.col("single").alias("n_a"))
    right = named.select(F.col("a").alias("b"), F.col("name").alias("skill_b"), F.col("single").alias("n_b"))
    pairs = counts.where("a < b").join(F.broadcast(left), "a").join(F.broadcast(right), "b")
    pairs = pairs.withColumn("one", F.lit(1)).join(F.broadcast(whole), "one")
    support = F.col("n") / F.col("jobs")
    lift = F.col("n").cast("double") * F.col("jobs") / (F.col("n_a") * F.col("n_b"))
    return pairs.where(support >= min_support).select(
        "skill_a", "skill_b", F.col("n").alias("job_count"),
        F.round(support, 6).alias("support"), F.round(lift, 6).alias("lift"),
    )
