"""Stored keys of a table, in buckets, so that a batch meets history without moving it.

Each load of a keyed table leaves the hashes of its keys, dealt into a fixed number of
sorted buckets. A batch sends its own keys to the same buckets and is compared there:
only the batch is shuffled, and only hashes of 32 bytes of the stored rows are read.
The keys of a load are written before the load is committed and count only for that
attempt, so they are neither missing nor left over.

The number of buckets is the session's number of shuffle partitions when the first load
is made; it is kept beside the keys, because files and readers must agree on it.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.functions.ids import stable_id
from skillgauge.sources.tables import append_load, read_table, table_loads


def _key(keys: list[str]) -> Column:
    return F.unhex(stable_id(*[F.col(k) for k in keys])).alias("key")


def _buckets(spark: SparkSession, root: str, table: str) -> int | None:
    row = read_table(spark, root, f"{table}_key_buckets", "n int").first()
    return row.n if row else None


def _key_table(spark: SparkSession, root: str, table: str, buckets: int) -> str:
    """Name under which this session knows the key files of a table."""
    path = f"{root}/{table}_keys"
    name = "keys_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    if not spark.catalog.tableExists(name):
        quoted = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} (key BINARY, attempt STRING) USING parquet "
            f"PARTITIONED BY (attempt) CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{quoted}'"
        )
    return name


def store_keys(rows: DataFrame, root: str, table: str, keys: list[str], attempt: str) -> None:
    """Keep the complete keys of rows that are about to be committed."""
    spark = rows.sparkSession
    buckets = _buckets(spark, root, table)
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        append_load(spark.createDataFrame([(buckets,)], "n int"), root, f"{table}_key_buckets", "1")
    name = _key_table(spark, root, table, buckets)
    hashed = rows.select(*keys).dropna(how="any").select(_key(keys))
    dealt = hashed.repartition(buckets, "key").withColumn("attempt", F.lit(attempt))
    dealt.write.format("parquet").mode("append").partitionBy("attempt").bucketBy(buckets, "key").sortBy(
        "key"
    ).option("path", f"{root}/{table}_keys").saveAsTable(name)


def known_keys(
    batch: DataFrame, root: str, table: str, keys: list[str], but: str | None = None
) -> DataFrame:
    """Those keys of the batch that loads other than ``but`` have stored."""
    spark = batch.sparkSession
    attempts = [load.attempt for load in table_loads(spark, root, table) if load.load_id != but]
    buckets = _buckets(spark, root, table) if attempts else None
    asked = batch.select(*keys).dropna(how="any").distinct()
    if not buckets:
        return asked.limit(0)
    name = _key_table(spark, root, table, buckets)
    spark.catalog.refreshTable(name)
    stored = spark.table(name).where(F.col("attempt").isin(*attempts)).select("key")
    # An inner join stays above the repartition, which gives the batch the buckets of the
    # stored keys whatever the session's number of partitions is.
    return asked.withColumn("key", _key(keys)).repartition(buckets, "key").join(stored, "key").select(*keys)
