"""Session settings and the shared working folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The setting cannot be changed once a session runs, so a local session's folder is
# kept here by application.
_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "skillgauge") -> SparkSession:
    """Session for tests and the bench. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # JSON-LD in the wild repeats keys; the last one counts.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="skillgauge-")
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/skillgauge/{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """Give costly per-row work enough tasks when a table has few splits.

    Only for plain scans: counting the splits of anything with a shuffle would
    run it. A table of many files comes back unchanged, so its rows never move.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
