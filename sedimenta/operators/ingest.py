"""Ingestion driven by control rows instead of one script per source."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import routing
from sedimenta.operators.incremental import LoadResult, incremental_load
from sedimenta.operators.runs import RunAudit
from sedimenta.operators.vault import mask_configured
from sedimenta.sources.tables import AppendTable, LandingTable, VersionedTable, WatermarkControl
from sedimenta.streaming import sinks


@dataclass(frozen=True)
class SourceSpec:
    """One control row."""

    pipeline_id: str
    name: str
    source_type: str
    target_table: str
    ingestion_mode: str
    primary_key: str
    watermark_column: str | None = None
    pii_columns: tuple[str, ...] = ()
    is_active: int = 1


def specs_from_rows(rows: list[dict]) -> list[SourceSpec]:
    """Control rows from the parsed form of a configuration file."""
    return [
        SourceSpec(
            r["id"], r["name"], r["source_type"], r["target_table"], r["ingestion_mode"], r["primary_key"],
            r.get("watermark_column"), tuple(r.get("pii_columns") or ()), int(r.get("is_active", 1)),
        )
        for r in rows
    ]


#: Errors of a source that may pass by themselves.
TRANSIENT = (ConnectionError, TimeoutError)


def ingest(
    spark: SparkSession, specs: list[SourceSpec], sources: dict[str, Callable[[], DataFrame]],
    root: str, run_id: str, reasons: dict[str, Column] | None = None, audit: RunAudit | None = None,
    tries: int = 3, wait_seconds: float = 0.5, pepper: str | None = None,
) -> list[LoadResult]:
    """Load every active source by its mode; the loop is over control rows only.

    A source that fails does not stop the others: its run ends as FAILED with the error, and the results name the loads that
    succeeded. A transient error is tried again, waiting twice as long each time. Rejected rows are appended to the
    quarantine of ``root`` in the same load. ``pepper`` is the secret of the tokens that stand for personal numbers. Without ``audit`` the first failure is raised after all sources were tried.
    """
    active = [s for s in specs if s.is_active]
    record = audit or RunAudit(spark, root)
    record.begin(run_id, [s.pipeline_id for s in active])
    results, failures = [], []
    for spec in active:
        at = record.start(run_id, spec.pipeline_id)
        try:
            result = _tried(lambda s=spec, at=at: _load(spark, s, sources[s.pipeline_id], root, run_id, reasons or {}, at, pepper), tries, wait_seconds)
        except Exception as error:
            record.fail(run_id, spec.pipeline_id, error)
            failures.append(error)
            continue
        record.succeed(run_id, spec.pipeline_id, result.extracted, result.loaded, result.rejected)
        results.append(result)
    if failures and audit is None:
        raise failures[0]
    return results


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The rejected rows of all loads below ``root`` as dead-letter records."""
    return AppendTable(spark, f"{root}/rejected_records").read()


def _tried(load: Callable[[], LoadResult], tries: int, wait: float) -> LoadResult:
    for attempt in range(1, tries + 1):
        try:
            return load()
        except TRANSIENT:
            if attempt == tries:
                raise
            time.sleep(wait * 2 ** (attempt - 1))
    raise ValueError("tries must be 1 or more")


def _quarantine(spark, target: LandingTable, spec: SourceSpec, root: str, run_id: str, run_ts: str) -> None:
    """Append the rejects of a run, once, from the rows it has landed."""
    rejects = routing.quarantine(
        target.rejected(run_id).drop("run_id"), run_id=run_id, pipeline_id=spec.pipeline_id, run_ts=run_ts,
        details=f"rejected by the load of {spec.name}")
    AppendTable(spark, f"{root}/rejected_records").append(rejects, f"{run_id}/{spec.pipeline_id}")


def _load(spark, spec: SourceSpec, source, root: str, run_id: str, reasons: dict, run_ts: str, pepper: str | None) -> LoadResult:
    path = f"{root}/{spec.target_table}"
    reason = reasons.get(spec.pipeline_id, F.lit(None).cast("string"))
    frame = mask_configured(source(), list(spec.pii_columns), pepper)
    if spec.ingestion_mode == "incremental":
        target = LandingTable(spark, path)
        result = incremental_load(
            frame, target, WatermarkControl(spark, root), pipeline_id=spec.pipeline_id,
            run_id=run_id, watermark_column=spec.watermark_column, reason=reason,
        )
        _quarantine(spark, target, spec, root, run_id, run_ts)
        return result
    if spec.ingestion_mode == "streaming_microbatch":
        sink = sinks.KeyedLog(spark, path, [spec.primary_key], [spec.watermark_column], frame.schema)
        extracted = sum(sinks.run_available(frame, sink.append, f"{path}/_checkpoint").values())
        return LoadResult(spec.pipeline_id, run_id, extracted, extracted, 0, "", "")
    if spec.ingestion_mode == "full_swap":
        table = VersionedTable(spark, path)
        version = table.publish(frame, run_id)
        count = table.read(version).count()
        return LoadResult(spec.pipeline_id, run_id, count, count, 0, "", "")
    if spec.ingestion_mode == "full_load":
        target = LandingTable(spark, path)
        m = target.write_run(frame.withColumn("reason_code", reason), run_id)
        _quarantine(spark, target, spec, root, run_id, run_ts)
        return LoadResult(spec.pipeline_id, run_id, m["extracted"], m["loaded"], m["rejected"], "", "")
    raise ValueError(f"unknown ingestion mode {spec.ingestion_mode}")
