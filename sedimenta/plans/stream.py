"""L: micro-batch streaming. Each query streams landed files and reads the final state.

Files are written in Spark's own partitions, so their number follows the data. Several deliveries land one after the
other and the stream continues from its checkpoint, a micro-batch or more each.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sedimenta.functions import text
from sedimenta.operators import routing
from sedimenta.plans import ingest as batch
from sedimenta.plans import landing
from sedimenta.plans.expected import expect
from sedimenta.plans.registry import query
from sedimenta.session import scratch_path
from sedimenta.sources import entities
from sedimenta.streaming import merging, row_source, sinks

DELIVERIES = 4
#: Streams that take 1,000 rows in turn, and rows of the row groups that are read to find them. Every stream has a planning
#: process on the driver, some 50 MB each: eight and the JVM take more than 1.5 GB there.
LANES, GROUP_ROWS = 4, 16 * row_source.MAX_ROWS


def _stream(spark, frame, arrival, make, handle, mode="append"):
    """Land the rows of each delivery and stream them; the rows per micro-batch.

    ``arrival`` numbers the deliveries, ``make`` turns the stream of files into the stream to handle.
    """
    path, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "checkpoint")
    rows = {}
    for delivery in range(DELIVERIES):
        landing.landed_rows(frame.where(arrival == delivery), path)
        rows |= sinks.run_available(make(sinks.ndjson_stream(spark, path, frame.schema)), handle, checkpoint, mode)
    return rows


def _scattered(*columns):
    """Deliveries that have nothing to do with the order of events."""
    return F.pmod(F.xxhash64(*columns), F.lit(DELIVERIES))


def _late(events):
    """Deliveries about a week apart; purchases come one delivery late."""
    week = F.floor((F.dayofmonth(F.to_timestamp_ntz("timestamp")) - 1) / 8)
    return F.least(week + F.when(F.col("event_type") == "purchase", 1).otherwise(0), F.lit(DELIVERIES - 1))


def _keyed_log(spark, events):
    return sinks.KeyedLog(spark, scratch_path(spark, "log"), ["user_id"], ["ts", "event_id"], landing.typed(events).schema)


_LATEST = """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
       arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events GROUP BY user_id"""


@query("L1_microbatch_key_replace", _LATEST)
def _(spark, sf):
    events = landing.app_events(spark, sf)
    log = _keyed_log(spark, events)
    _stream(spark, events, _scattered("event_id"), landing.typed, log.append)
    return log.snapshot()


@query("L2_bounded_microbatches", f"""
SELECT b AS batch_id, least({row_source.MAX_ROWS}, (SELECT count(*) FROM events) - b * {row_source.MAX_ROWS}) AS row_count
FROM (SELECT unnest(range((SELECT CAST(ceil(count(*) / {row_source.MAX_ROWS}.0) AS BIGINT) FROM events))) AS b)""")
def _(spark, sf):
    # Every micro-batch is cut at 1,000 rows, wherever that is in a file.
    events = entities.events(spark, sf)
    path, root = scratch_path(spark, "arrived"), scratch_path(spark, "stream")
    events.write.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(path)
    out = sinks.BatchFiles(spark, f"{root}/out")

    def lane(k):
        return row_source.parquet_rows(spark, path, events.schema, lane=k, lanes=LANES)

    sinks.run_lanes(lane, LANES, out.append, f"{root}/_checkpoint")
    return out.read().groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(F.count(F.lit(1)).alias("row_count"))


@query("L3_late_events_daily_counts", """
SELECT date_trunc('day', ts)::TIMESTAMP AS day_start, event_type, count(*) AS event_count FROM events GROUP BY 1, 2""")
def _(spark, sf):
    # The watermark waits longer than any event is late.
    events = landing.app_events(spark, sf)
    log = sinks.BatchFiles(spark, scratch_path(spark, "counts"))

    def counts(stream):
        timed = stream.select("event_type", F.to_timestamp("timestamp").alias("ts"))
        return sinks.daily_counts(timed, "ts", "event_type", "12 days")

    _stream(spark, events, _late(events), counts, log.append, mode="update")
    # Counts only grow, so the newest update of a window is its greatest.
    return log.read().groupBy(F.col("day_start").cast("timestamp_ntz").alias("day_start"), "event_type").agg(
        F.max("event_count").alias("event_count")
    )


_ARRIVED = """
arrived AS (SELECT *, least(floor((dayofmonth(ts) - 1) / 8) + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END, 3) AS delivery FROM events),
newest AS (SELECT d AS delivery, (SELECT max(ts) FROM arrived WHERE delivery < d) - INTERVAL 3 DAY AS watermark
  FROM (SELECT unnest(range(4)) AS d)),
routed AS (SELECT a.*, n.watermark IS NOT NULL AND a.ts < n.watermark AS late FROM arrived a JOIN newest n USING (delivery))"""


@query("L3_late_rows_diverted", "WITH " + _ARRIVED + """
SELECT date_trunc('day', ts)::TIMESTAMP AS day_start, event_type, count(*) FILTER (NOT late) AS event_count,
       count(*) FILTER (late) AS late_count FROM routed GROUP BY 1, 2""")
def _(spark, sf):
    # The watermark waits three days: purchases of the early days of a week come behind it and are set aside.
    events = landing.app_events(spark, sf)
    sink = sinks.LateRows(spark, scratch_path(spark, "late"), "ts", datetime.timedelta(days=3))
    _stream(spark, events, _late(events), landing.typed, sink.append)
    kept = sink.table.valid().withColumn("late", F.lit(0))
    both = kept.unionByName(sink.table.rejected().drop("reason_code").withColumn("late", F.lit(1)))
    return both.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day_start"), "event_type").agg(
        F.sum(1 - F.col("late")).alias("event_count"), F.sum("late").alias("late_count"))


@query("L3_late_rows_per_batch", "WITH " + _ARRIVED + """
SELECT CAST(delivery AS BIGINT) AS batch_id, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late FROM routed GROUP BY 1""")
def _(spark, sf):
    events = landing.app_events(spark, sf)
    sink = sinks.LateRows(spark, scratch_path(spark, "late"), "ts", datetime.timedelta(days=3))
    _stream(spark, events, _late(events), landing.typed, sink.append)
    return sink.counts()


@query("L3_latest_state_by_event_time", _LATEST)
def _(spark, sf):
    events = landing.app_events(spark, sf)
    log = _keyed_log(spark, events)
    _stream(spark, events, _late(events), landing.typed, log.append)
    log.compact()
    return log.snapshot()


@query("L4_stream_deduplication", "SELECT event_type, count(*) AS event_count, sum(event_id)::BIGINT AS id_sum FROM events GROUP BY event_type")
def _(spark, sf):
    events = landing.app_events(spark, sf)
    twice = events.unionByName(events).unionByName(events.where(F.col("event_type") == "click"))
    log = sinks.BatchFiles(spark, scratch_path(spark, "distinct"))

    def distinct(stream):
        return sinks.distinct_within(stream.withColumn("ts", F.to_timestamp("timestamp")), ["event_id"], "ts", "31 days")

    # A repeat comes with its original or in any other delivery.
    again = twice.withColumn("copy", F.monotonically_increasing_id())
    _stream(spark, again, _scattered("copy"), distinct, log.append)
    return log.read().groupBy("event_type").agg(F.count("*").alias("event_count"), F.sum("event_id").alias("id_sum"))


@query("L5_streaming_cdc_merge", expect(batch._ENVELOPED, "headers", "items"))
def _(spark, sf):
    # Every micro-batch is merged as it arrives; the changes of an order come in any order and batch.
    changes = batch.envelopes(spark, sf)
    orders = entities.order_headers(spark, sf).select("order_id", "order_status", "total_amount")
    merge = merging.EnvelopeMerge(spark, scratch_path(spark, "merged"), "order_id", orders.schema, changes.schema, batch.SEQ)
    merge.seed(orders)
    _stream(spark, changes, _scattered("ts_ms", *batch.SEQ), lambda stream: stream, merge.append)
    return merge.read()


@query("L6_restart_from_checkpoint", """
SELECT 'before' AS phase, count(*) AS row_count FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
UNION ALL SELECT 'after', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'
UNION ALL SELECT 'stored', count(*) FROM events""")
def _(spark, sf):
    events = landing.app_events(spark, sf)
    path, root = scratch_path(spark, "restart"), scratch_path(spark, "stream")
    log = sinks.BatchFiles(spark, f"{root}/out")
    first = F.col("timestamp") < "2024-01-16"
    counts = []
    for part in (events.where(first), events.where(~first)):
        part.write.mode("append").json(path)
        stream = sinks.ndjson_stream(spark, path, events.schema)
        counts.append(sum(sinks.run_available(stream, log.append, f"{root}/_checkpoint").values()))
    runs = spark.createDataFrame(list(zip(("before", "after"), counts)), "phase string, row_count bigint")
    stored = log.read().agg(F.count("*").alias("row_count")).select(F.lit("stored").alias("phase"), "row_count")
    return runs.unionByName(stored)


@query("L7_stream_dead_letters", expect("""
SELECT customer_id, CASE WHEN email NOT LIKE '%@%' THEN 'INVALID_EMAIL' WHEN balance < 0 THEN 'NEGATIVE_AMOUNT' ELSE 'VALID' END AS outcome
FROM customers""", "customers"))
def _(spark, sf):
    customers = entities.customers(spark, sf).select("customer_id", "email", "balance")
    reason = routing.first_reason({text.INVALID_EMAIL: routing.invalid_email(), text.NEGATIVE_AMOUNT: routing.negative("balance")})
    log = sinks.RoutedLog(spark, scratch_path(spark, "routed"), reason)
    _stream(spark, customers, _scattered("customer_id"), lambda stream: stream, log.append)
    valid = log.table.valid().select("customer_id", F.lit("VALID").alias("outcome"))
    return valid.unionByName(log.table.rejected().select("customer_id", F.col("reason_code").alias("outcome")))
