"""Micro-batches: row caps, late rows, and merging into buckets."""

import datetime
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import cdc
from sedimenta.plans import QUERIES, landing
from sedimenta.session import scratch_path
from sedimenta.sources.readers import SCHEMAS
from sedimenta.streaming import merging, row_source, sinks


def local(path):
    return path.replace("file:", "", 1)


# --- batches of at most so many rows ---


def landed(spark, path, first, end, files):
    spark.range(first, end).repartition(files).write.mode("append").option("parquet.block.size", 2048).parquet(path)


def test_row_cap_and_restart(spark):
    path, root = scratch_path(spark, "capped"), scratch_path(spark, "out")
    out = sinks.BatchFiles(spark, f"{root}/f")

    def run():
        return sinks.run_batches(row_source.parquet_rows(spark, path, spark.range(1).schema, 300), out.append, f"{root}/c")

    landed(spark, path, 0, 1000, 3)
    assert run() == {0: 300, 1: 300, 2: 300, 3: 100}
    assert run() == {}
    landed(spark, path, 1000, 1350, 2)
    assert run() == {4: 300, 5: 50}
    assert sorted(r.id for r in out.read().collect()) == list(range(1350))


def test_a_batch_that_failed_is_read_again(spark):
    path, root = scratch_path(spark, "capped"), scratch_path(spark, "out")
    out = sinks.BatchFiles(spark, f"{root}/f")
    landed(spark, path, 0, 700, 2)

    def fails(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")
        out.append(batch, batch_id)

    stream = lambda: row_source.parquet_rows(spark, path, spark.range(1).schema, 300)
    with pytest.raises(Exception, match="lost"):
        sinks.run_batches(stream(), fails, f"{root}/c")
    assert sinks.run_batches(stream(), out.append, f"{root}/c") == {1: 300, 2: 100}
    assert sorted(r.id for r in out.read().collect()) == list(range(700))


def test_a_file_behind_the_place_is_noticed(spark):
    path, root = scratch_path(spark, "capped"), scratch_path(spark, "out")
    out = sinks.BatchFiles(spark, f"{root}/f")
    landed(spark, path, 0, 10, 1)
    stream = lambda: row_source.parquet_rows(spark, path, spark.range(1).schema, 300)
    sinks.run_batches(stream(), out.append, f"{root}/c")
    older = scratch_path(spark, "older")
    landed(spark, older, 10, 20, 1)
    for name in os.listdir(local(older)):
        if name.endswith(".parquet"):
            os.rename(f"{local(older)}/{name}", f"{local(path)}/{name}")
            os.utime(f"{local(path)}/{name}", (1, 1))
    with pytest.raises(Exception, match="files up to the one that was read last"):
        sinks.run_batches(stream(), out.append, f"{root}/c")


def test_lanes_take_stripes_in_turn(spark):
    path, root = scratch_path(spark, "capped"), scratch_path(spark, "out")
    out = sinks.BatchFiles(spark, f"{root}/f")

    def run():
        lane = lambda k: row_source.parquet_rows(spark, path, spark.range(1).schema, 300, k, 3)
        return sinks.run_lanes(lane, 3, out.append, f"{root}/c")

    landed(spark, path, 0, 1000, 3)
    assert run() == {0: 300, 1: 300, 2: 300, 3: 100}
    assert run() == {}
    landed(spark, path, 1000, 1850, 2)
    # The first lane takes what is left of its stripe, then the next one; rows 1200 to 1799 are the other lanes'.
    assert run() == {6: 200, 4: 300, 5: 300, 9: 50}
    assert sorted(r.id for r in out.read().collect()) == list(range(1850))


def test_bounded_batches_run_side_by_side(spark, monkeypatch):
    most, running, lock, append = [0], [0], threading.Lock(), sinks.BatchFiles.append

    def watched(self, batch, batch_id):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        append(self, batch, batch_id)
        with lock:
            running[0] -= 1

    monkeypatch.setattr(sinks.BatchFiles, "append", watched)
    path = scratch_path(spark, "given")
    events = spark.range(10_500).selectExpr(
        "id event_id", "id % 7 user_id", "'view' event_type", "timestamp_ntz'2024-01-01' ts", "double(id) value", "'' props")
    events.select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], SCHEMAS["events"]).schema]).write.parquet(f"{path}/events.parquet")
    rows = {r.batch_id: r.row_count for r in QUERIES["L2_bounded_microbatches"].build(spark, path).collect()}
    assert rows == {b: 1_000 for b in range(10)} | {10: 500} and most[0] > 1


def planners():
    """The processes that plan micro-batches of Python sources."""
    found = set()
    for pid in filter(str.isdigit, os.listdir("/proc")):
        try:
            with open(f"/proc/{pid}/cmdline", "rb") as file:
                if b"python_streaming_source_runner" in file.read():
                    found.add(pid)
        except OSError:
            pass  # it has ended
    return found


def test_bounded_batches_are_planned_by_few_processes(spark, monkeypatch):
    before, seen, append = planners(), set(), sinks.BatchFiles.append

    def watched(self, batch, batch_id):
        seen.update(planners() - before)
        append(self, batch, batch_id)

    monkeypatch.setattr(sinks.BatchFiles, "append", watched)
    path = scratch_path(spark, "given")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], SCHEMAS["events"]).schema]
    spark.range(9_001).select(*columns).write.parquet(f"{path}/events.parquet")
    rows = {r.batch_id: r.row_count for r in QUERIES["L2_bounded_microbatches"].build(spark, path).collect()}
    assert rows == {b: 1_000 for b in range(9)} | {9: 1}
    assert 1 < len(seen) <= 4


def test_slices_cut_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": list(range(100)), "b": ["x"] * 100}), tmp_path / "f.parquet", row_group_size=7)
    reader = row_source.RowCappedReader(str(tmp_path), 10, ["a"])
    for first, end in ((0, 100), (0, 1), (6, 8), (13, 22), (99, 100), (50, 50)):
        batches = list(reader.read(row_source.Slice(str(tmp_path / "f.parquet"), first, end)))
        assert [v for b in batches for v in b.column("a").to_pylist()] == list(range(first, end))
        assert all(b.schema.names == ["a"] for b in batches)


# --- rows behind the watermark ---


def test_late_rows_are_set_aside(spark, rows):
    sink = sinks.LateRows(spark, scratch_path(spark, "late"), "ts", datetime.timedelta(days=1))
    batch = lambda *days: spark.createDataFrame(
        [(i, d and datetime.datetime(2024, 1, d)) for i, d in days], "id int, ts timestamp_ntz")
    sink.append(batch((1, 5), (2, 1)), 0)  # nothing is late before the first watermark
    sink.append(batch((3, 4), (4, 3), (5, None)), 1)  # behind the fifth less a day is late
    sink.append(batch(), 2)
    sink.append(batch((6, 9), (7, 4)), 3)
    sink.append(batch((6, 9), (7, 4)), 3)  # replayed: cut at the same time
    sink.append(batch((8, 7)), 4)
    assert rows(sink.table.valid().select("id")) == [(1,), (2,), (3,), (6,), (7,)]
    assert rows(sink.table.rejected().select("id", "reason_code")) == [
        (4, "LATE_EVENT"), (5, "MISSING_EVENT_TIME"), (8, "LATE_EVENT")]
    assert rows(sink.counts()) == [(0, 2, 0), (1, 1, 2), (2, 0, 0), (3, 2, 0), (4, 0, 1)]


def test_the_late_query_keeps_and_diverts(spark, sf):
    total = QUERIES["L3_late_rows_diverted"].build(spark, sf).agg(F.sum("event_count"), F.sum("late_count")).first()
    assert min(total) > 0


# --- merging into buckets ---

ROW = "k bigint, v string"
ENVELOPE = "op string, ts_ms bigint, n int, before struct<k: bigint, v: string>, after struct<k: bigint, v: string>"


def envelope(op, ts, n, k, v=None):
    return (op, ts, n, (k, "old") if op == "d" else None, None if op == "d" else (k, v))


def merging_table(spark, most_rows=50):
    row, envelopes = (spark.createDataFrame([], s).schema for s in (ROW, ENVELOPE))
    return merging.EnvelopeMerge(spark, scratch_path(spark, "buckets"), "k", row, envelopes, ["n"], most_rows)


def files_below(path):
    return sorted((d, f, os.stat(f"{d}/{f}").st_mtime_ns) for d, _, names in os.walk(local(path)) for f in names)


def test_merging_batches_in_any_order_equals_one_merge(spark, rows):
    rng = random.Random(2)
    stored = spark.createDataFrame([(k, "first") for k in range(400)], ROW)
    changes = [envelope(rng.choice("ccud"), rng.randrange(40), n, rng.randrange(600), f"v{n}") for n in range(900)]
    table = merging_table(spark)
    table.seed(stored)
    order = changes[:]
    rng.shuffle(order)
    for i in range(6):
        table.append(spark.createDataFrame(order[i::6], ENVELOPE), i)
    want = cdc.apply_envelopes(stored, spark.createDataFrame(changes, ENVELOPE), "k", ["n"])
    assert rows(table.read()) == rows(want)
    sizes = [e["rows"] for e in table.buckets.table.entries().values()]
    assert len(sizes) > 8 and max(sizes) <= 100


def test_repeated_and_null_keys_of_the_seed_stay(spark, rows):
    table = merging_table(spark)
    table.seed(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], ROW))
    batch = [envelope("u", 2, 0, 1, "x"), envelope("u", 1, 0, 1, "older"), envelope("c", 1, 0, None, "n"), envelope("d", 1, 0, 3)]
    table.append(spark.createDataFrame(batch, ENVELOPE), 0)
    assert rows(table.read()) == sorted([(1, "x"), (1, "x"), (2, "c"), (None, "d"), (None, "e"), (None, "n")], key=repr)


def test_a_batch_is_shuffled_and_written_once(spark, monkeypatch):
    table, written, materialise = merging_table(spark), [], merging.materialise
    monkeypatch.setattr(merging, "materialise", lambda df, label: written.append(label) or materialise(df, label))
    table.seed(spark.createDataFrame([(k, "a") for k in range(400)], ROW))
    table.append(spark.createDataFrame([envelope("u", 1, 0, k, "b") for k in range(400)], ENVELOPE), 0)
    assert written == ["newest"]
    # All of a bucket lies in one task, which writes one file.
    for entry in table.buckets.table.entries().values():
        assert len([f for f in os.listdir(local(entry["path"])) if f.endswith(".parquet")]) == 1


def test_deliveries_are_compressed(spark):
    path = scratch_path(spark, "landed")
    landing.landed_rows(spark.range(2_000).selectExpr("id", "'text' v"), path)
    names = [f for f in os.listdir(local(path)) if f.startswith("part-")]
    assert names and all(f.endswith(".json.gz") for f in names)
    stream = sinks.ndjson_stream(spark, path, spark.read.schema("id bigint, v string").json(path).schema)
    out = sinks.BatchFiles(spark, scratch_path(spark, "read"))
    assert sum(sinks.run_available(stream, out.append, scratch_path(spark, "c")).values()) == 2_000


def test_a_replayed_batch_changes_no_file(spark, rows):
    table = merging_table(spark)
    table.seed(spark.createDataFrame([(k, "a") for k in range(100)], ROW))
    batch = spark.createDataFrame([envelope("u", 1, 0, 5, "b"), envelope("d", 1, 0, 6)], ENVELOPE)
    table.append(batch, 0)
    before, state = files_below(table.buckets.table.root), rows(table.read())
    again = merging_table(spark)
    again.buckets.table = table.buckets.table
    again.append(batch, 0)
    assert files_below(table.buckets.table.root) == before and rows(again.read()) == state
    assert again.progress[0]["rows_written"] == 0 and table.progress[0]["rows_written"] > 0


def test_rows_read_per_batch_do_not_grow_with_the_table(spark):
    read = {}
    for n in (500, 5_000):
        table = merging_table(spark, most_rows=50)
        table.seed(spark.createDataFrame([(k, "a") for k in range(n)], ROW))
        keys = random.Random(1).sample(range(n), 4)
        table.append(spark.createDataFrame([envelope("u", 1, 0, k, "b") for k in keys], ENVELOPE), 0)
        read[n] = table.progress[0]["rows_read"]
        assert table.progress[0]["buckets_read"] <= 4 and table.read().where("v = 'b'").count() == 4
    # A bucket is filled to twice its size at most before it is split, by hashing unevenly a little more.
    assert max(read.values()) <= 4 * 100


def test_an_empty_table_takes_a_stream(spark, rows):
    table = merging_table(spark)
    assert table.read().collect() == []
    table.append(spark.createDataFrame([envelope("c", 2, 0, 1, "x"), envelope("c", 1, 0, 1, "w"), envelope("d", 3, 0, 2)], ENVELOPE), 0)
    table.append(spark.createDataFrame([envelope("c", 1, 0, 2, "older than its end")], ENVELOPE), 1)
    assert rows(table.read()) == [(1, "x")]
