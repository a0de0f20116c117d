"""Streaming sources and sinks.

A micro-batch appends only its own latest row per key, in a directory named by its batch id. A
replayed batch replaces its directory, which makes the sink exactly-once, and the cost of a batch
does not depend on the size of the table. Readers take the latest row per key; ``compact`` folds
the collected batches into a new base version.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sedimenta.operators.merge import latest_per_key
from sedimenta.session import path_exists
from sedimenta.sources.commits import CommitLog
from sedimenta.sources.tables import LandingTable, VersionedTable


def ndjson_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, max_bytes: str | None = None, **options
) -> DataFrame:
    """Newline JSON files as a stream; ``max_files`` or ``max_bytes`` (such as ``"1g"``) bounds a micro-batch."""
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType, max_rows: int) -> DataFrame:
    """A topic of JSON values; ``max_rows`` bounds a micro-batch. Needs the Kafka package on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_rows)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")


Handler = Callable[[DataFrame, int], None]


def run_available(stream: DataFrame, handle: Handler, checkpoint: str, mode: str = "append") -> dict[int, int]:
    """Process what has arrived and stop; returns the rows read per micro-batch.

    The checkpoint keeps the progress, so the next call continues where this one ended.
    """
    counted, rows = _counted(handle)
    _writer(stream, counted, checkpoint, mode).trigger(availableNow=True).start().awaitTermination()
    return rows


def run_batches(stream: DataFrame, handle: Handler, checkpoint: str, mode: str = "append") -> dict[int, int]:
    """As ``run_available``, for sources that bound a micro-batch themselves and would else be read in one."""
    counted, rows = _counted(handle)
    query = _writer(stream, counted, checkpoint, mode).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return rows


def run_lanes(lane: Callable[[int], DataFrame], lanes: int, handle: Handler, checkpoint: str, mode: str = "append") -> dict[int, int]:
    """As ``run_batches``, for a stream dealt to lanes that run side by side, each with a checkpoint of its own.

    Batch n of a lane is batch n * lanes + lane of the whole. A checkpoint stays with its number of lanes.
    """
    counted, rows = _counted(handle)

    def numbered(k: int) -> Handler:
        return lambda batch, batch_id: counted(batch, batch_id * lanes + k)

    queries = []
    try:
        for k in range(lanes):
            writer = _writer(lane(k), numbered(k), f"{checkpoint}/{lanes}-{k}", mode)
            queries.append(writer.trigger(processingTime="0 seconds").start())
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return rows


def _counted(handle: Handler) -> tuple[Handler, dict[int, int]]:
    """The handler, which must read its batch, and the rows of each batch it has handled."""
    rows: dict[int, int] = {}

    def counted(batch: DataFrame, batch_id: int) -> None:
        observation = Observation()
        handle(batch.observe(observation, F.count(F.lit(1)).alias("rows")), batch_id)
        rows[batch_id] = observation.get["rows"]

    return counted, rows


def run_every(stream: DataFrame, handle: Handler, checkpoint: str, interval: str, mode: str = "append") -> StreamingQuery:
    """Keep processing in fixed intervals, for instance ``"10 seconds"``."""
    return _writer(stream, handle, checkpoint, mode).trigger(processingTime=interval).start()


def _writer(stream: DataFrame, handle: Handler, checkpoint: str, mode: str):
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)


class KeyedLog:
    """Latest row per key, stored as per-batch directories over a compacted base."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], seq: list[str], schema: T.StructType):
        self.spark = spark
        self.root = root
        self.keys = keys
        self.seq = seq
        self.schema = schema
        self.base = VersionedTable(spark, f"{root}/base")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, self.keys, self.seq)
        newest.write.mode("overwrite").parquet(f"{self.root}/log/batch_id={batch_id}")

    def batches(self) -> DataFrame:
        schema = T.StructType(self.schema.fields + [T.StructField("batch_id", T.LongType())])
        log = f"{self.root}/log"
        if not path_exists(self.spark, log):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(log)

    def _compacted_through(self) -> int:
        current = self.base.current()
        return -1 if current is None else int(current["run_id"])

    def snapshot(self) -> DataFrame:
        """Current state. Only batches newer than the base are read besides it."""
        through = self._compacted_through()
        rows = self.batches().where(F.col("batch_id") > through).drop("batch_id")
        if through >= 0:
            rows = rows.unionByName(self.base.read())
        return latest_per_key(rows, self.keys, self.seq)

    def compact(self) -> None:
        """Fold all batches so far into a new base version."""
        last = self.batches().agg(F.max("batch_id").alias("b")).first()["b"]
        if last is not None and last > self._compacted_through():
            self.base.publish(self.snapshot(), str(last))


class RoutedLog:
    """Valid and rejected rows of each micro-batch; the batch id is the run id."""

    def __init__(self, spark: SparkSession, root: str, reason: Column):
        self.table = LandingTable(spark, root)
        self.reason = reason

    def append(self, batch: DataFrame, batch_id: int) -> None:
        self.table.write_run(batch.withColumn("reason_code", self.reason), f"batch-{batch_id}")


class LateRows:
    """Rows behind the watermark go to dead letters, all others are kept; both are counted per micro-batch.

    The watermark of a batch is the greatest event time of the batches before it, less ``delay``. It is committed with
    the counts of every batch, so a replayed batch is cut at the same time. Rows without event time are dead letters too.
    """

    LATE, UNTIMED = "LATE_EVENT", "MISSING_EVENT_TIME"

    def __init__(self, spark: SparkSession, root: str, ts: str, delay: datetime.timedelta):
        self.table = LandingTable(spark, root)
        self.log = CommitLog(spark, f"{root}/_watermarks")
        self.ts = ts
        self.delay = delay // datetime.timedelta(microseconds=1)

    def append(self, batch: DataFrame, batch_id: int) -> None:
        before = self.log.get(batch_id)["newest"] if batch_id else None
        at = F.unix_micros(F.col(self.ts).cast("timestamp"))
        reason = F.when(at.isNull(), self.UNTIMED)
        if before is not None:
            reason = reason.when(at < before - self.delay, self.LATE)
        counts = self.table.write_run(batch.withColumn("reason_code", reason), f"batch-{batch_id}", F.max(at).alias("newest"))
        newest = max((t for t in (before, counts["newest"]) if t is not None), default=None)
        self.log.put(batch_id + 1, {"batch_id": batch_id, "kept": counts["loaded"], "late": counts["rejected"], "newest": newest})

    def counts(self) -> DataFrame:
        return self.log.frame("batch_id bigint, kept bigint, late bigint")


class BatchFiles:
    """Plain per-batch append, for stateful outputs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def append(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.root)


def distinct_within(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay``; state is bounded by the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, ts: str, by: str, delay: str) -> DataFrame:
    """Events per day and type by event time; late events count until the watermark passes."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day"), by)
        .agg(F.count("*").alias("event_count"))
        .select(F.col("window.start").alias("day_start"), by, "event_count")
    )
