"""Logs of finished writes: what was written whole, in which order, and where.

A write puts its rows into a folder of its own and only then adds a row to a log.
Readers look up the folders in the log, so a write that was broken off, or one that is
still going on, is not seen, and a repeated write takes the place of the first one in
one step. Each commit is one small file; two writers that commit at the same time
collide on its name and the second one fails.

A log row says which ``folder`` holds the rows of a load, and its ``sequence``: the
number the load got when it was first committed, which a repeat keeps. ``attempt`` names
the write itself and stays when the rows are moved to another folder.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

LOG = "version long, sequence long, load_id string, folder string, n_rows long, attempt string"


@dataclass(frozen=True)
class Load:
    version: int
    sequence: int
    load_id: str
    folder: str
    n_rows: int
    attempt: str


def read_log(spark: SparkSession, path: str) -> list[Load]:
    """All rows of a log, oldest first: one short row for each commit of a load."""
    try:
        rows = spark.read.schema(LOG).option("recursiveFileLookup", "true").json(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((Load(*row) for row in rows), key=lambda load: (load.version, load.sequence))


def live_loads(log: list[Load]) -> list[Load]:
    """The rows that count: the newest of each load, in order of sequence."""
    newest = {load.load_id: load for load in log}
    return sorted(newest.values(), key=lambda load: load.sequence)


def next_load(log: list[Load], load_id: str, folder: str, n_rows: int = 0) -> Load:
    """The row that a commit of this load adds."""
    version = max((load.version for load in log), default=0) + 1
    last = max((load.sequence for load in log), default=0)
    known = {load.load_id: load.sequence for load in log}
    return Load(version, known.get(load_id, last + 1), load_id, folder, n_rows, folder)


def moved_loads(log: list[Load], loads: list[Load], folder: str) -> list[Load]:
    """The rows that say that these loads now lie in ``folder``."""
    version = max(load.version for load in log) + 1
    return [replace(load, version=version, folder=folder) for load in loads]


def commit(spark: SparkSession, path: str, loads: list[Load]) -> None:
    """Add rows of one version. Fails if another writer has committed that version."""
    rows = spark.createDataFrame([astuple(load) for load in loads], LOG).coalesce(1)
    rows.write.mode("error").json(f"{path}/version={loads[0].version:012d}")


def stamp_order(stamp: str) -> tuple[int, int, str]:
    """Order of names: numbers by value, so that "10" follows "9", other names as text
    after them."""
    return (0, int(stamp), stamp) if stamp.isdecimal() else (1, 0, stamp)
