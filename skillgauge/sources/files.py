"""Saved pages, JSON exports and CSV exports."""

import os
from dataclasses import replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.functions.text import newline_normalised
from skillgauge.sources.commits import commit, live_loads, next_load, read_log, stamp_order
from skillgauge.sources.tables import counted


def _pages(files: DataFrame) -> DataFrame:
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content"))
    return files.select(
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        newline_normalised(text.cast("string")).alias("html"),
    )


def read_pages(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """One row per ``*.html`` file: path, name and text; a file that is not UTF-8
    has a null text.

    Many small files: raise ``spark.sql.files.maxPartitionBytes`` or lower
    ``openCostInBytes``, and keep the result as a table (``compact_pages``).
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.html")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    return _pages(files.select("path", "content"))


def stream_pages(
    spark: SparkSession,
    folder: str,
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """``read_pages`` for files as they arrive. With ``archive``, files of earlier
    batches are moved there once a later batch commits. ``max_files`` bounds a
    micro-batch, so that a large backlog is taken in steps."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.html")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", archive
        )
    return _pages(reader.load(folder).select("path", "content"))


def compact_pages(pages: DataFrame, path: str) -> None:
    """Keep pages as a columnar table, so that later runs open few files."""
    pages.write.mode("overwrite").parquet(path)


def write_export(df: DataFrame, root: str, export_ts: str) -> str:
    """JSON lines in a folder of the export's own; returns its path. A repeated write
    takes the place of the first one when it is whole. Null fields are written, so every
    line has all keys."""
    return write_counted_export(df, root, export_ts)[0]


def write_counted_export(df: DataFrame, root: str, export_ts: str) -> tuple[str, int]:
    """``write_export``, with the number of rows that were written."""
    spark, log_path = df.sparkSession, f"{root}_log"
    log = read_log(spark, log_path)
    load = next_load(log, export_ts, f"export_ts={export_ts}")
    if any(known.folder == load.folder for known in log):
        load = replace(load, folder=f"{load.folder}.{load.version}")
    rows, seen = counted(df)
    path = f"{root}/{load.folder}"
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    commit(spark, log_path, [replace(load, n_rows=seen.get["n"])])
    return path, seen.get["n"]


def read_exports(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All exports below ``root`` with their ``export_ts``."""
    parts = [
        spark.read.schema(schema).json(f"{root}/{load.folder}").withColumn("export_ts", F.lit(load.load_id))
        for load in live_loads(read_log(spark, f"{root}_log"))
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"{schema}, export_ts string")


def latest_stamp(spark: SparkSession, root: str) -> str:
    """Name of the newest whole export: numbers by value, other names as text. Raises
    ``FileNotFoundError`` if there is none."""
    stamps = [load.load_id for load in live_loads(read_log(spark, f"{root}_log"))]
    if not stamps:
        raise FileNotFoundError(f"no exports in {root}")
    return max(stamps, key=stamp_order)


def read_export(spark: SparkSession, root: str, schema: str, stamp: str) -> DataFrame:
    """One export; no file of another one is opened. Raises ``FileNotFoundError`` if no
    whole export has this name."""
    for load in live_loads(read_log(spark, f"{root}_log")):
        if load.load_id == stamp:
            return spark.read.schema(schema).json(f"{root}/{load.folder}")
    raise FileNotFoundError(f"no export {stamp} in {root}")


def latest_export(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return read_export(spark, root, schema, latest_stamp(spark, root))


def write_array_export(df: DataFrame, path: str, rows: int = 10_000) -> None:
    """Files of one JSON array each, with at most ``rows`` objects. Null fields are
    written."""
    number = F.monotonically_increasing_id()
    cut = df.select(F.struct("*").alias("row"), number.alias("at"))
    # The upper part of the number is the task's, so an array never spans two tasks.
    part, block = F.shiftright("at", 33), F.floor(F.col("at").bitwiseAND(2**33 - 1) / rows)
    packed = cut.groupBy(part.alias("part"), block.alias("block")).agg(F.collect_list("row").alias("rows"))
    line = F.to_json("rows", {"ignoreNullFields": "false"})
    packed.select(line.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def read_array_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Export files that hold one JSON array of objects each."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Quotes are doubled, line ends stay inside quotes, and an
    empty string differs from a null."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("quoteAll", "true")
        .option("emptyValue", "")
        .option("nullValue", "\\N")
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("multiLine", "true")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", "")
        .option("nullValue", "\\N")
        .csv(path)
    )


def _move_one(path: str, folder: str) -> str:
    """Move one file; a move that an earlier attempt made counts as made."""
    from pyarrow import fs

    source_fs, source = fs.FileSystem.from_uri(path)
    target_fs, target_root = fs.FileSystem.from_uri(folder)
    target = f"{target_root}/{os.path.basename(source)}"
    try:
        missing = fs.FileType.NotFound
        if source_fs.get_file_info(source).type == missing:
            there = target_fs.get_file_info(target).type != missing
            return "moved" if there else "failed"
        if target_fs.get_file_info(target).type != missing:
            # Another file of this name was moved before: neither may be lost.
            return "failed"
        target_fs.create_dir(target_root, recursive=True)
        source_fs.move(source, target)
        return "moved"
    except OSError:
        return "failed"


def move_files(paths: DataFrame, folder: str) -> DataFrame:
    """Move the files named in ``file_path`` into ``folder``, from the executors.

    Returns (file_path, status). The moves happen when the result is read; a
    repeated read, or a task that is run again, finds them done.
    """

    def move(batches):
        for batch in batches:
            status = [_move_one(path, folder) for path in batch["file_path"]]
            yield pd.DataFrame({"file_path": batch["file_path"], "status": status})

    return paths.select("file_path").mapInPandas(
        move, "file_path string, status string"
    )


def move_summary(moves: DataFrame) -> DataFrame:
    """One row: moved, failed."""
    return moves.agg(
        F.count_if(F.col("status") == "moved").alias("moved"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
