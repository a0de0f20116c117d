"""The record of runs, and loads of which some fail."""

import itertools

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.ingest import ingest, quarantined, specs_from_rows
from sedimenta.operators.runs import RunAudit
from sedimenta.session import scratch_path
from sedimenta.sources.tables import AppendTable


def clock():
    ticks = itertools.count()
    return lambda: f"2024-01-01 00:00:{next(ticks):02d}"


def spec(name, mode="full_load"):
    return {"id": name, "name": name, "source_type": "table", "target_table": f"t_{name}", "ingestion_mode": mode, "primary_key": "id",
            "watermark_column": "at"}


def source(spark, n):
    return lambda: spark.sql(f"SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id)) AS at FROM range({n})")


def states(audit):
    return [(r.run_id, r.pipeline_id, r.status, str(r.start_time)[-2:], str(r.end_time)[-2:]) for r in
            audit.frame().orderBy("run_id", "pipeline_id").collect()]


def test_one_failing_source_stops_no_other(spark, rows):
    root, audit = scratch_path(spark, "runs"), None
    audit = RunAudit(spark, root, clock())
    audit.start("r0", "b")  # this run dies
    reasons = {"a": F.when(F.col("id") == 1, "MISSING_PK")}
    specs = specs_from_rows([spec("a"), spec("b", "incremental"), spec("c"), spec("d", "no such mode")])

    def broken():
        raise ValueError("no such column\nin the plan")

    results = ingest(spark, specs, {"a": source(spark, 5), "b": source(spark, 3), "c": broken, "d": source(spark, 1)}, root, "r1", reasons, audit)
    assert [(r.pipeline_id, r.loaded, r.rejected) for r in results] == [("a", 4, 1), ("b", 3, 0)]
    assert states(audit) == [
        ("r0", "b", "FAILED", "00", "01"), ("r1", "a", "SUCCESS", "02", "03"), ("r1", "b", "SUCCESS", "04", "05"),
        ("r1", "c", "FAILED", "06", "07"), ("r1", "d", "FAILED", "08", "09")]
    errors = {r.pipeline_id: r.error_message for r in audit.frame().where("error_message is not null").collect() if r.run_id == "r1"}
    assert errors == {"c": "ValueError: no such column", "d": "ValueError: unknown ingestion mode no such mode"}
    assert {r.run_id: (r.status, r.failed_loads) for r in audit.run_status().collect()} == {"r0": ("FAILED", 1), "r1": ("PARTIAL", 2)}
    (reject,) = quarantined(spark, root).collect()
    assert (reject.run_id, reject.pipeline_id, reject.reason_code, str(reject.created_at)) == ("r1", "a", "MISSING_PK", "2024-01-01 00:00:02")
    assert '"id":1' in reject.raw_payload

    # The run is repeated: what was loaded stays as it is, also the quarantine.
    again = ingest(spark, specs_from_rows([spec("a"), spec("b", "incremental"), spec("c")]),
                   {"a": source(spark, 5), "b": source(spark, 3), "c": source(spark, 2)}, root, "r1", reasons, audit)
    assert [(r.pipeline_id, r.loaded) for r in again] == [("a", 4), ("b", 3), ("c", 2)]
    assert quarantined(spark, root).count() == 1
    assert {s[1]: s[2] for s in states(audit) if s[0] == "r1"} == {"a": "SUCCESS", "b": "SUCCESS", "c": "SUCCESS", "d": "FAILED"}


def test_without_a_record_the_failure_is_raised_after_all_were_tried(spark):
    root = scratch_path(spark, "runs")
    tried = []

    def broken():
        tried.append("a")
        raise ValueError("broken")

    def fine():
        tried.append("b")
        return source(spark, 1)()

    with pytest.raises(ValueError, match="broken"):
        ingest(spark, specs_from_rows([spec("a"), spec("b")]), {"a": broken, "b": fine}, root, "r1")
    assert tried == ["a", "b"]


def test_transient_errors_are_tried_again(spark):
    root, calls = scratch_path(spark, "runs"), []
    audit = RunAudit(spark, root, clock())

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError("slow")
        return source(spark, 2)()

    assert ingest(spark, specs_from_rows([spec("a")]), {"a": flaky}, root, "r1", audit=audit, wait_seconds=0)[0].loaded == 2
    assert len(calls) == 3
    calls[:] = [1] * -10
    assert ingest(spark, specs_from_rows([spec("a")]), {"a": flaky}, root, "r2", audit=audit, tries=2, wait_seconds=0) == []
    assert audit.frame().where("run_id = 'r2'").first()["error_message"] == "TimeoutError: slow"


def test_partial_above_a_share_of_rejects(spark):
    audit = RunAudit(spark, scratch_path(spark, "runs"), clock(), partial_above=0.1)
    for run, rejected in (("r1", 10), ("r2", 11)):
        audit.start(run, "a")
        audit.succeed(run, "a", 100, 100 - rejected, rejected)
    assert [s[2] for s in states(audit)] == ["SUCCESS", "PARTIAL"]
    audit.start("r3", "a")
    assert {r.run_id: r.status for r in audit.run_status().collect()} == {"r1": "SUCCESS", "r2": "PARTIAL", "r3": "STARTED"}
    assert audit.states().count() == 5


def test_a_batch_is_appended_once(spark, rows):
    table = AppendTable(spark, scratch_path(spark, "append"))
    with pytest.raises(ValueError):
        table.read()
    table.append(spark.range(2), "a")
    table.append(spark.range(9), "a")
    table.append(spark.range(0), "b")
    table.append(spark.range(5, 6), "c")
    assert rows(table.read()) == [(0,), (1,), (5,)]
