"""Pages as a stream: each micro-batch is parsed and merged into ``jobs``.

The checkpoint makes every file count once. A micro-batch that is run again
replaces its own partition of each table, so the tables end up the same.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skillgauge import schemas
from skillgauge.operators.extract import SOURCE
from skillgauge.plans.pipeline import merge_jobs, parse_pages
from skillgauge.sources.files import read_export

# Apart from the exports of batch runs, of which the newest is loaded.
_EXPORTS = "exports/stream"


def _load_prefix(spark: SparkSession, checkpoint: str) -> str:
    """Name of this stream's loads, kept with its checkpoint. A new checkpoint
    counts batches from zero again and must not replace the loads of an old one."""
    path = f"{checkpoint}/load_prefix"
    try:
        return spark.read.text(path).first().value
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    prefix = f"stream-{uuid.uuid4().hex}"
    spark.range(1).select(F.lit(prefix).alias("value")).write.text(path)
    return prefix


def ingest_stream(
    pages: DataFrame,
    root: str,
    checkpoint: str,
    source: str = SOURCE,
    now: Column | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start reading all pages that are there now; the query ends by itself.

    ``pages`` is a streaming frame with ``file_name`` and ``html``. Start it again
    with the same checkpoint to take in what has come since. ``partitions`` spreads
    each micro-batch before it is parsed, for sources of few large files.
    """
    loaded_at = F.current_timestamp() if now is None else now
    prefix = _load_prefix(pages.sparkSession, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        stamp = f"{prefix}-{batch_id:09d}"
        spark = batch.sparkSession
        given = batch if partitions is None else batch.repartition(partitions)
        parse_pages(given, root, stamp, source, exports=_EXPORTS)
        export = read_export(spark, f"{root}/{_EXPORTS}", schemas.JOBS_EXPORT, stamp)
        merge_jobs(export, root, stamp, loaded_at)

    return (
        pages.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
