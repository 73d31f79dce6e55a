"""Daily downloads from a stream of events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skillgauge.functions.ids import stable_id
from skillgauge.sources.tables import append_load, read_table

DAYS = "package_id string, date date, downloads long"


def count_stream(
    events: DataFrame, root: str, checkpoint: str, lateness: str = "7 days", table: str = "download_days"
) -> StreamingQuery:
    """Count events (package_id, ts) by package and day; the query ends by itself.

    Days stay in the state until the watermark, ``lateness`` behind the newest event, has
    passed them; later events of such days are dropped. Each micro-batch stores the new
    totals of the days it touched as one load.
    """
    days = (
        events.withWatermark("ts", lateness)
        .groupBy("package_id", F.window("ts", "1 day").alias("day"))
        .agg(F.count("*").alias("downloads"))
        .select("package_id", F.to_date("day.start").alias("date"), "downloads")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        append_load(batch, root, table, f"{batch_id:012d}")

    return (
        days.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_downloads(spark, root: str, now: Column, table: str = "download_days") -> DataFrame:
    """The newest total of each package and day."""
    days = read_table(spark, root, table, DAYS)
    newest = days.groupBy("package_id", "date").agg(F.max_by("downloads", "load_id").alias("downloads"))
    return newest.select(
        stable_id(F.col("package_id"), F.col("date")).alias("download_id"),
        "*",
        now.cast("timestamp_ntz").alias("created_at"),
    )


def with_missing_days(days: DataFrame) -> DataFrame:
    """``days`` (package_id, date, downloads) with a zero for each day without events
    between the first and the last day of any package."""
    ends = days.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    calendar = ends.where("first is not null").select(F.sequence("first", "last").alias("dates"))
    packages = days.select("package_id").distinct()
    # One row with all dates is sent to the packages.
    every = packages.withColumn("one", F.lit(1)).join(F.broadcast(calendar.withColumn("one", F.lit(1))), "one")
    every = every.select("package_id", F.explode("dates").alias("date"))
    return every.join(days.select("package_id", "date", "downloads"), ["package_id", "date"], "left").select(
        "package_id", "date", F.coalesce("downloads", F.lit(0)).cast("long").alias("downloads")
    )
