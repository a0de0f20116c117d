"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library wants; all of them can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose output is grouped by the join key is otherwise left unsplit.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Whether Spark removes a query's shuffle files when it ends; else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(app: str, cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of its own; on a cluster a machine-local folder would not be visible to executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="sedimenta-")
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[app], ignore_errors=True)
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back.

    Cuts the lineage in a way that survives the loss of executors and, unlike a cached or
    checkpointed RDD, keeps the columns prunable for the passes that follow. Nothing reads the shuffle files
    of the write again, so they go with it: a job of many steps holds those of one step at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    kept = spark.conf.get(SHUFFLE_CLEANUP) != "true"
    if kept:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if kept:
            spark.conf.set(SHUFFLE_CLEANUP, "false")
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what ``materialise`` has written, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        location = spark._jvm.org.apache.hadoop.fs.Path(folder)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
