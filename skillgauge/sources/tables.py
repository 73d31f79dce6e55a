"""Stored tables: one Parquet folder a load, and a log of the loads that are whole.

A load that is run again is written to a new folder and takes the place of the first
one with its commit, so a repeated load leaves what a single one does and readers never
see half of it. Folders that no live load needs are left alone; they can be deleted
when no reader uses them any more.
"""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skillgauge.sources.commits import (
    Load,
    commit,
    live_loads,
    moved_loads,
    next_load,
    read_log,
)


def _log(root: str, table: str) -> str:
    return f"{root}/{table}_log"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and its number of rows ``n`` once it has been written.

    The count is taken by the tasks that write, each of which counts once, so it needs
    no second reading and is right also when tasks are run again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def append_load(df: DataFrame, root: str, table: str, load_id: str) -> int:
    """Write a load, or write it again. Returns its number of rows."""
    spark, path, folder = df.sparkSession, _log(root, table), uuid.uuid4().hex
    rows, seen = counted(df.withColumn("load_id", F.lit(load_id)))
    rows.write.parquet(f"{root}/{table}/{folder}")
    commit(spark, path, [next_load(read_log(spark, path), load_id, folder, seen.get["n"])])
    return seen.get["n"]


def append_keyed_load(df: DataFrame, root: str, table: str, load_id: str, keys: list[str]) -> int:
    """``append_load`` for a table whose keys later batches are compared with."""
    from skillgauge.sources.keys import store_keys

    spark, path, folder = df.sparkSession, _log(root, table), uuid.uuid4().hex
    rows, seen = counted(df.withColumn("load_id", F.lit(load_id)))
    rows.write.parquet(f"{root}/{table}/{folder}")
    written = spark.read.schema(rows.schema).parquet(f"{root}/{table}/{folder}")
    store_keys(written, root, table, keys, folder)
    commit(spark, path, [next_load(read_log(spark, path), load_id, folder, seen.get["n"])])
    return seen.get["n"]


def table_loads(spark: SparkSession, root: str, table: str) -> list[Load]:
    """The loads of a table in the order in which they were first made."""
    return live_loads(read_log(spark, _log(root, table)))


def _rows(spark: SparkSession, path: str, schema: str, log: list[Load], loads: list[Load]) -> DataFrame:
    full = f"{schema}, load_id string"
    wanted, held = {}, {}
    for load in loads:
        wanted.setdefault(load.folder, set()).add(load.load_id)
    for load in log:
        held.setdefault(load.folder, set()).add(load.load_id)
    reader = spark.read.schema(full)
    whole = [f"{path}/{folder}" for folder, ids in wanted.items() if ids == held[folder]]
    parts = [reader.parquet(*whole)] if whole else []
    # A folder of several loads, of which some were replaced or are not asked for.
    for folder, ids in wanted.items():
        if ids != held[folder]:
            parts.append(reader.parquet(f"{path}/{folder}").where(F.col("load_id").isin(*ids)))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], full)


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    schema: str,
    but: str | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """All loads of a table, with ``load_id``; empty if nothing was loaded yet.

    ``but`` leaves out one load: the one that is being written. ``only`` picks loads;
    the folders of others are not opened.
    """
    log = read_log(spark, _log(root, table))
    loads = [
        load
        for load in live_loads(log)
        if load.load_id != but and (only is None or load.load_id in only)
    ]
    return _rows(spark, f"{root}/{table}", schema, log, loads)


def read_loads(
    spark: SparkSession, root: str, table: str, schema: str, loads: list[str]
) -> DataFrame:
    """Some loads of a table; the folders of others are not opened."""
    return read_table(spark, root, table, schema, only=loads)


def compact_loads(spark: SparkSession, root: str, table: str, schema: str, keep: int = 1) -> int:
    """Write all loads but the newest ``keep`` into one folder of few files. Returns how
    many loads were moved. Rows keep their ``load_id``, and a load that was moved can
    still be replaced."""
    path, folder = _log(root, table), uuid.uuid4().hex
    log = read_log(spark, path)
    loads = live_loads(log)
    loads = loads[: max(len(loads) - keep, 0)]
    if len({load.folder for load in loads}) < 2:
        return 0
    rows, seen = counted(_rows(spark, f"{root}/{table}", schema, log, loads))
    rows.write.parquet(f"{root}/{table}/{folder}")
    expected = sum(load.n_rows for load in loads)
    if seen.get["n"] != expected:
        raise RuntimeError(f"{table}: {seen.get['n']} of {expected} rows were read")
    commit(spark, path, moved_loads(log, loads, folder))
    return len(loads)
