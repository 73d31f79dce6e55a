"""WARC archives in Zstandard: one frame per record, dictionary in the first frame.

A file starts with a skippable frame that holds the dictionary; each record is a
frame of its own, followed by an empty skippable frame. Spark's text writer makes
the files: it puts a separator after each row, and that separator *is* the empty
skippable frame. So files are committed by Spark, on any file system it can write,
and a lost task leaves nothing behind.

Defined cases: a null payload is an empty one; a null record id is written as an
empty name and read as null; rows that share the smallest id and the payload are
all responses; equal payloads below ``min_bytes`` are all responses.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the Zstandard and WARC formats.
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

RECORDS_PER_FILE = 8192
SAMPLE_RECORDS = 256
SAMPLE_BYTES = 4096
DICTIONARY_BYTES = 16384
BROADCAST_ROWS = 50_000

RECORD_SCHEMA = (
    "record_id string, record_type string, uri string, refers_to string, "
    "payload_bytes long, payload_digest string, error string"
)


def train_dictionary(
    records: DataFrame, payload: str, sample: int = SAMPLE_RECORDS, size: int = DICTIONARY_BYTES
) -> bytes:
    """Compression dictionary from at most ``sample`` records, 4 KB of each.

    Too few samples to train on become a plain-content dictionary; none gives
    ``b""``, and the files then have no dictionary.
    """
    head = F.substring(F.col(payload).cast("binary"), 1, SAMPLE_BYTES)
    rows = records.select(head.alias("head")).where("length(head) > 0").limit(sample)
    parts = [bytes(row.head) for row in rows.collect()]
    if not parts:
        return b""
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


def mark_revisits(
    records: DataFrame, record_id: str, payload: str, min_bytes: int, shared: str
) -> DataFrame:
    """Adds ``refers_to``: the smallest id with the same payload, null for that one.

    Payloads move only if the digests that occur twice are too many to broadcast;
    those are stored below ``shared`` first, so their count is known.
    """
    spark = records.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    digest = F.unhex(F.sha2(body, 256))
    (
        records.where(F.octet_length(body) >= min_bytes)
        .select(digest.alias("__digest"), F.col(record_id).alias("__first"))
        .groupBy("__digest")
        .agg(F.min("__first").alias("__first"), F.count("*").alias("__n"))
        .where("__n > 1 AND __first IS NOT NULL")
        .drop("__n")
        .write.parquet(shared)
    )
    firsts = spark.read.parquet(shared)
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    known = F.when(F.octet_length(body) >= min_bytes, digest)
    joined = records.withColumn("__digest", known).join(firsts, "__digest", "left")
    other = F.when(F.col(record_id) != F.col("__first"), F.col("__first"))
    return joined.withColumn("refers_to", other).drop("__digest", "__first")


def _headers(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"


def build_record(record_id, uri, refers_to, payload: bytes, date: str) -> bytes:
    """One record; a revisit names the response and carries no payload."""
    digest = hashlib.sha256(payload).hexdigest()
    block = b"" if refers_to is not None else HTTP_HEAD % len(payload) + payload
    head = _headers([
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if record_id is None else record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if uri is None else " ".join(uri.split())),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ])
    return head + block + b"\r\n\r\n"


def write_archives(
    records: DataFrame,
    path: str,
    dictionary: bytes,
    date: str,
    columns: tuple[str, str, str, str] = ("record_id", "uri", "refers_to", "payload"),
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Writes ``columns`` (id, uri, referred id, payload) as ``.txt`` archives below ``path``.

    A file holds at most ``records_per_file`` records; each starts with the
    dictionary, which the row that opens a file carries in front.
    """
    lead = DICTIONARY_MAGIC + struct.pack("<I", len(dictionary)) + dictionary
    lead = lead if dictionary else b""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = {"write_content_size": True}
        if dictionary:
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        pack = zstandard.ZstdCompressor(level=3, **options).compress
        done = 0
        for batch in batches:
            names, uris, others, bodies = batch.columns
            out = []
            for name, uri, other, body in zip(
                names.to_pylist(), uris.to_pylist(), others.to_pylist(), bodies, strict=True
            ):
                payload = body.as_py() or b""
                frame = pack(build_record(name, uri, other, payload, date))
                out.append(lead + frame if done % records_per_file == 0 else frame)
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    name, uri, other, payload = columns
    rows = records.select(
        F.col(name).cast("string"), F.col(uri), F.col(other).cast("string"), F.col(payload).cast("binary")
    )
    (
        rows.mapInArrow(frames, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def frame_end(data: bytes, at: int) -> int:
    """End of the frame that starts at ``at``, from its header and block headers."""
    magic = data[at : at + 4]
    if len(magic) < 4:
        raise ValueError("cut frame")
    if magic[1:] == b"\x2a\x4d\x18" and magic[0] >> 4 == 5:
        if len(data) < at + 8:
            raise ValueError("cut frame")
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
    elif magic == ZSTD_MAGIC:
        flags = data[at + 4]
        single = flags >> 5 & 1
        sizes = (single, 2, 4, 8)[flags >> 6]
        end = at + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + sizes
        last = 0
        while not last:
            if end + 3 > len(data):
                raise ValueError("cut frame")
            block = int.from_bytes(data[end : end + 3], "little")
            last, kind = block & 1, block >> 1 & 3
            end += 3 + (1 if kind == 1 else block >> 3)
        end += 4 * (flags >> 2 & 1)
    else:
        raise ValueError("no frame magic")
    if end > len(data):
        raise ValueError("cut frame")
    return end


def _name(value: str | None) -> str | None:
    if value is None:
        return None
    if not (value.startswith("<urn:page:") and value.endswith(">")):
        raise ValueError("bad record id")
    return value[10:-1] or None


def parse_record(data: bytes) -> dict:
    """Fields of one record, with its lengths and digest checked against its bytes."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version != VERSION:
        raise ValueError("bad version line")
    fields = {}
    for line in lines:
        key, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError("bad header line")
        fields[key.lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if key not in fields:
            raise ValueError(f"no {key}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("content length differs")
    kind = fields["warc-type"]
    size = int(fields["warc-payload-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    payload = None
    if kind == "response":
        _, blank, payload = rest[:length].partition(b"\r\n\r\n")
        if not blank or len(payload) != size:
            raise ValueError("payload length differs")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload digest differs")
    elif kind != "revisit" or length or "warc-refers-to" not in fields:
        raise ValueError("bad revisit or type")
    return {
        "record_id": _name(fields["warc-record-id"]),
        "record_type": kind,
        "uri": fields.get("warc-target-uri"),
        "refers_to": _name(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
        "error": None,
    }


def read_file(data: bytes) -> Iterator[dict]:
    """Records of one archive; what cannot be read is a row with ``error``."""
    at, options = 0, {}
    unpack = None
    while at < len(data):
        try:
            end = frame_end(data, at)
            if data[at : at + 4] == DICTIONARY_MAGIC:
                if at:
                    raise ValueError("dictionary is not the first frame")
                options = {"dict_data": zstandard.ZstdCompressionDict(data[8:end])}
            elif data[at : at + 4] == ZSTD_MAGIC:
                unpack = unpack or zstandard.ZstdDecompressor(**options).decompress
                yield parse_record(unpack(data[at:end]))
        except (ValueError, KeyError, zstandard.ZstdError) as problem:
            yield {"error": str(problem)}
            if str(problem) in ("cut frame", "no frame magic"):
                return
        at = end


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of all archives below ``path``; ``payloads`` adds the bodies."""
    schema = RECORD_SCHEMA + (", payload binary" if payloads else "")
    fields = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64() if f == "payload_bytes" else pa.binary() if f == "payload" else pa.string() for f in fields]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in read_file(content.as_py()):
                    rows.append(row)
                    if len(rows) == 1024:
                        yield table(rows)
                        rows = []
                yield table(rows)

    def table(rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r.get(f) for r in rows], k) for f, k in zip(fields, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, fields)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.select("content").mapInArrow(records, schema)


def checked(column: Column, error: Column) -> Column:
    """The column, or a failed job where a record could not be validated."""
    broken = F.raise_error(F.concat(F.lit("archive: "), error))
    return F.when(error.isNotNull(), broken).otherwise(column)
