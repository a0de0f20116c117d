"""Run audit, service levels and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.incremental import LoadResult

AUDIT_SCHEMA = (
    "run_id string, pipeline_id string, status string, records_extracted bigint, "
    "records_loaded bigint, records_rejected bigint"
)


def audit_rows(spark, results: list[LoadResult], status: str = "SUCCESS") -> DataFrame:
    """Audit rows of finished loads; the key is (run_id, pipeline_id)."""
    return spark.createDataFrame(
        [(r.run_id, r.pipeline_id, status, r.extracted, r.loaded, r.rejected) for r in results], AUDIT_SCHEMA
    )


def kpi_report(audit: DataFrame) -> DataFrame:
    """Runs, volumes and success rate per load."""
    ok = F.when(F.col("status") == "SUCCESS", 1).otherwise(0)
    return audit.groupBy("pipeline_id").agg(
        F.count("run_id").alias("total_runs"),
        F.sum(ok).cast("bigint").alias("successful_runs"),
        F.sum("records_extracted").alias("total_extracted"),
        F.sum("records_loaded").alias("total_loaded"),
        F.sum("records_rejected").alias("total_rejected"),
        F.round(F.sum(ok) * 100.0 / F.count("run_id"), 2).cast("double").alias("success_rate_pct"),
    )


def status_sla(audit: DataFrame) -> DataFrame:
    """Latest run of each load, and whether it met its service level."""
    latest = F.max_by(
        F.struct("status", "end_time", "records_loaded", "records_rejected"), F.struct("end_time", "run_id")
    )
    return audit.groupBy("pipeline_id").agg(latest.alias("r")).select(
        "pipeline_id",
        F.col("r.end_time").alias("last_processed_ts"),
        F.col("r.status").alias("last_run_status"),
        F.col("r.records_loaded").alias("records_loaded"),
        F.col("r.records_rejected").alias("records_rejected"),
        F.when(F.col("r.status") == "SUCCESS", "SLA_MET").otherwise("SLA_BREACH").alias("sla_compliance"),
    )


def freshness_sla(audit: DataFrame, as_of: str, threshold_minutes: int) -> DataFrame:
    """Minutes since the last successful run of each load, against a limit."""
    last = F.max(F.when(F.col("status") == "SUCCESS", F.col("end_time"))).alias("last_success_ts")
    age = F.timestamp_diff("MINUTE", F.col("last_success_ts"), F.lit(as_of).cast("timestamp_ntz"))
    return (
        audit.groupBy("pipeline_id").agg(last)
        .withColumn("minutes_since_success", age)
        .withColumn(
            "freshness",
            F.when(F.col("minutes_since_success") < threshold_minutes, "SLA_MET").otherwise("SLA_BREACH"),
        )
    )


def completeness(audit: DataFrame) -> DataFrame:
    """Extracted must equal loaded plus rejected, per run."""
    gap = F.col("records_extracted") - F.col("records_loaded") - F.col("records_rejected")
    return audit.select(
        "run_id", "pipeline_id", "records_extracted", "records_loaded", "records_rejected",
        gap.alias("unaccounted"), F.when(gap == 0, "SLA_MET").otherwise("SLA_BREACH").alias("completeness"),
    )


def duration_sla(audit: DataFrame, limit_seconds: int) -> DataFrame:
    """Run time and throughput, against a limit."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return audit.select("run_id", "pipeline_id", "records_loaded", seconds.alias("duration_seconds")).withColumns({
        "rows_per_second": F.when(
            F.col("duration_seconds") > 0, F.col("records_loaded").cast("double") / F.col("duration_seconds").cast("double")
        ),
        "duration": F.when(F.col("duration_seconds") <= limit_seconds, "SLA_MET").otherwise("SLA_BREACH"),
    })


def reconcile_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either side with their presence; both sides are reduced to distinct keys first."""
    a = left.select(key).distinct().withColumn("in_source", F.lit(1))
    b = right.select(key).distinct().withColumn("in_target", F.lit(1))
    return a.join(b, key, "full_outer").select(
        key, F.coalesce("in_source", F.lit(0)).alias("in_source"), F.coalesce("in_target", F.lit(0)).alias("in_target")
    )
