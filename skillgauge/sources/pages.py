"""Folders of saved pages as a data source, and reading each page once.

``spark.read.format("saved_pages").load(folder)`` gives one row per page file below the
folder, with its name, size and time; ``.write.format("saved_pages").save(folder)``
saves rows of (file_name, html) as files, with ``fan`` dealt into that many subfolders.
The driver lists only the top of a folder: subfolders are listed by the tasks that read
them, and files at the top are dealt out by size. Keep large folders in subfolders, as
``fan`` does; then no list of files is held anywhere. Files are opened by ``pyarrow.fs``: local paths, ``hdfs://``, ``s3://``.

``consume_folder`` reads what is new in a folder, hands it on, and moves it away. A run
first copies the new pages into a table, which is its input from then on, then hands them
on, then moves the files and notes them as moved. So it can be broken off anywhere and
started again, no page is taken twice, and the small files are opened once.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from skillgauge.functions.text import newline_normalised
from skillgauge.sources.tables import append_load, read_table, table_loads

FORMAT = "saved_pages"
PAGES = "file_path string, file_name string, size long, modified timestamp_ntz, content binary"
SUFFIX = ".html"
#: Files at the top of a folder are dealt into parts of about this many bytes. A small
#: file counts as ``OPEN_BYTES``, for the time it takes to open it.
PART_BYTES = 64 * 2**20
OPEN_BYTES = 64 * 2**10
PARTS = 64

TAKEN = "file_path string, file_name string, size long, modified timestamp_ntz, html string"
MOVED = "file_path string, status string"


def file_system(path: str):
    """(file system, path in it) of a folder or file. A plain path is local."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class _Part(InputPartition):
    """Subfolders to list and read, or names of files at the top to read."""

    folders: list[str]
    files: list[str]


class _Reader(DataSourceReader):
    def __init__(self, folder: str, parts: int, part_bytes: int):
        self.folder, self.parts, self.part_bytes = folder, parts, part_bytes

    def partitions(self) -> list[_Part]:
        from pyarrow import fs

        system, top = file_system(self.folder)
        parts, folders, files, held = [], [], [], 0
        for info in system.get_file_info(fs.FileSelector(top)):
            if info.type == fs.FileType.Directory and not info.base_name.startswith((".", "_")):
                folders.append(info.base_name)
            elif info.is_file and info.base_name.endswith(SUFFIX):
                files.append(info.base_name)
                held += max(info.size, OPEN_BYTES)
                if held >= self.part_bytes:
                    parts.append(_Part([], files))
                    files, held = [], 0
        if files:
            parts.append(_Part([], files))
        folders.sort()
        parts += [_Part(folders[no :: self.parts], []) for no in range(min(self.parts, len(folders)))]
        return parts or [_Part([], [])]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, top = file_system(self.folder)

        def found():
            for name in partition.folders:
                for info in system.get_file_info(fs.FileSelector(f"{top}/{name}", recursive=True)):
                    if info.is_file and info.base_name.endswith(SUFFIX):
                        yield info
            for first in range(0, len(partition.files), 1024):
                names = partition.files[first : first + 1024]
                yield from (i for i in system.get_file_info([f"{top}/{n}" for n in names]) if i.is_file)

        schema = pa.schema([
            ("file_path", pa.string()), ("file_name", pa.string()), ("size", pa.int64()),
            ("modified", pa.timestamp("us")), ("content", pa.binary()),
        ])
        rows, held = [], 0
        for info in found():
            with system.open_input_stream(info.path) as stream:
                content = stream.read()
            changed = info.mtime.replace(tzinfo=None) if info.mtime else None
            rows.append((info.path, info.base_name, len(content), changed, content))
            held += len(content)
            if held >= 8 * 2**20 or len(rows) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


@dataclass
class _Written(WriterCommitMessage):
    n: int


class _Writer(DataSourceArrowWriter):
    """Each task writes its pages under their own names. A file appears under its name
    only when it is whole, and a task that is run again writes the same files. Texts stay
    in their Arrow batch; one at a time is taken from it."""

    def __init__(self, folder: str, fan: int):
        self.folder, self.fan = folder, fan

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        system, top = file_system(self.folder)
        n, made = 0, set()
        for name, html in (pair for batch in batches for pair in zip(batch["file_name"], batch["html"], strict=True)):
            name = name.as_py()
            folder = f"{top}/{zlib.crc32(name.encode()) % self.fan:05d}" if self.fan else top
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            partial = f"{folder}/_{uuid.uuid4().hex}"
            with system.open_output_stream(partial) as stream:
                stream.write(html.as_buffer() if html.is_valid else b"")
            system.move(partial, f"{folder}/{name}")
            n += 1
        return _Written(n)


class SavedPages(DataSource):
    """Options: ``path``, the folder; reading: ``parts``, tasks for all subfolders
    together, and ``partBytes``, bytes a task for files at the top; writing: ``fan``,
    subfolders to deal the files into."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> _Reader:
        parts, part_bytes = self.options.get("parts", PARTS), self.options.get("partbytes", PART_BYTES)
        return _Reader(self.options["path"], int(parts), int(part_bytes))

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("saved pages are added to a folder, never replaced")
        return _Writer(self.options["path"], int(self.options.get("fan", 0)))


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Page files below ``folder``: path, name, size, time and text; a file that is not
    UTF-8 has a null text."""
    spark.dataSource.register(SavedPages)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    files = spark.read.format(FORMAT).option("parts", parts).load(folder)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content"))
    return files.select("file_path", "file_name", "size", "modified", newline_normalised(text.cast("string")).alias("html"))


def write_folder(pages: DataFrame, folder: str, fan: int = 0) -> None:
    """Save pages (file_name, html) as files, in ``fan`` subfolders. Names must differ."""
    pages.sparkSession.dataSource.register(SavedPages)
    pages.select("file_name", "html").write.format(FORMAT).option("fan", fan).mode("append").save(folder)


def _move_file(path: str, top: str, target: str) -> str:
    """Move one file below ``top`` to the same place below ``target``. A move that an
    earlier attempt made counts as made; another file in its place is not replaced."""
    from pyarrow import fs

    system, base = file_system(top)
    other, goal = file_system(target)
    name = path.removeprefix(base.rstrip("/") + "/")
    there = f"{goal}/{name}"
    missing = fs.FileType.NotFound
    try:
        if system.get_file_info(path).type == missing:
            return "moved" if other.get_file_info(there).type != missing else "failed"
        if other.get_file_info(there).type != missing:
            return "failed"
        other.create_dir(os.path.dirname(there), recursive=True)
        system.move(path, there)
        return "moved"
    except OSError:
        return "failed"


def move_pages(files: DataFrame, folder: str, target: str) -> DataFrame:
    """(file_path, status) of moving these files of ``folder`` below ``target``, keeping
    their subfolders. The moves happen in tasks, when the result is read."""

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            status = [_move_file(path, folder, target) for path in batch["file_path"]]
            yield pd.DataFrame({"file_path": batch["file_path"], "status": status})

    return files.select("file_path").mapInPandas(move, MOVED)


def consume_folder(
    spark: SparkSession, folder: str, root: str, run: str, take: Callable[[str, DataFrame], None]
) -> None:
    """Give the new pages of a folder to ``take``, once, and move their files.

    ``take(run, pages)`` stores what it makes of the pages; calling it twice for a run
    must leave what calling it once does. A run that was broken off is finished when it,
    or a later one, is started. The pages of a run are in the table ``page_files``, what
    became of their files in ``moved_files``. A file that could not be moved is not taken
    again while it stays as it was.
    """
    taken = {load.load_id for load in table_loads(spark, root, "page_files")}
    moved = {load.load_id for load in table_loads(spark, root, "moved_files")}

    def finish(one: str) -> None:
        pages = read_table(spark, root, "page_files", TAKEN, only=[one]).drop("load_id")
        take(one, pages)
        target = f"{folder.rstrip('/')}_processed/{one}"
        append_load(move_pages(pages, folder, target), root, "moved_files", one)

    for one in sorted(taken - moved):
        finish(one)
    if run in taken:
        return
    stuck = read_table(spark, root, "moved_files", MOVED).where("status <> 'moved'").select("file_path", "load_id")
    pages = read_folder(spark, folder)
    if not stuck.isEmpty():
        seen = read_table(spark, root, "page_files", TAKEN).join(stuck, ["file_path", "load_id"], "left_semi")
        same = ["file_path", "size", "modified"]
        pages = pages.join(seen.select(*same).distinct(), same, "left_anti")
    append_load(pages, root, "page_files", run)
    finish(run)
