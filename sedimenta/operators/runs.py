"""The record of runs: STARTED, then SUCCESS, PARTIAL or FAILED, each state appended as a commit.

A run that died leaves STARTED as its last state. The next run of the load closes it as FAILED, so at most the
running ones are open. Times come from a clock that is passed in.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.sources.commits import CommitLog

STARTED, SUCCESS, PARTIAL, FAILED = "STARTED", "SUCCESS", "PARTIAL", "FAILED"

_STATE_SCHEMA = (
    "number bigint, run_id string, pipeline_id string, status string, at string, records_extracted bigint, "
    "records_loaded bigint, records_rejected bigint, error_message string"
)


def utc_now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%d %H:%M:%S.%f")


class RunAudit:
    """States of the runs of all loads; ``frame`` has one row per run and load."""

    def __init__(self, spark: SparkSession, root: str, now: Callable[[], str] = utc_now, partial_above: float | None = None):
        self.spark = spark
        self.log = CommitLog(spark, f"{root}/_audit")
        self.now = now
        self.partial_above = partial_above

    def begin(self, run_id: str, pipeline_ids: list[str]) -> None:
        """Close what earlier runs of these loads left open."""
        open_ = self.frame().where((F.col("status") == STARTED) & F.col("pipeline_id").isin(*pipeline_ids))
        for row in open_.orderBy("pipeline_id", "run_id").collect():
            error = f"ended without a result, closed by {run_id}"
            self._append(row["run_id"], row["pipeline_id"], FAILED, error_message=error)

    def start(self, run_id: str, pipeline_id: str) -> str:
        """Record that a load begins; the time."""
        return self._append(run_id, pipeline_id, STARTED)

    def succeed(self, run_id: str, pipeline_id: str, extracted: int, loaded: int, rejected: int) -> None:
        """A load that came to its end: PARTIAL if more than the share ``partial_above`` of its rows was rejected."""
        partial = self.partial_above is not None and rejected > self.partial_above * extracted
        self._append(run_id, pipeline_id, PARTIAL if partial else SUCCESS,
                     records_extracted=extracted, records_loaded=loaded, records_rejected=rejected)

    def fail(self, run_id: str, pipeline_id: str, error: BaseException) -> None:
        first_line = next(iter(str(error).splitlines()), "")
        self._append(run_id, pipeline_id, FAILED, error_message=f"{type(error).__name__}: {first_line}")

    def states(self) -> DataFrame:
        """Every state of every run."""
        return self.log.frame(_STATE_SCHEMA)

    def frame(self) -> DataFrame:
        """The last state of each run and load, with the times of its last start and end."""
        states = self.states().withColumn("at", F.col("at").cast("timestamp_ntz"))
        started = F.col("status") == STARTED
        counts = ["records_extracted", "records_loaded", "records_rejected", "error_message"]
        last = F.max_by(F.struct("status", "at", *counts), "number").alias("_last")
        begun = F.max_by("at", F.when(started, F.col("number"))).alias("start_time")
        return states.groupBy("run_id", "pipeline_id").agg(last, begun).select(
            "run_id", "pipeline_id", "_last.status", "start_time",
            F.when(F.col("_last.status") != STARTED, F.col("_last.at")).alias("end_time"), *[f"_last.{c}" for c in counts])

    def run_status(self) -> DataFrame:
        """A run over several loads: PARTIAL when some of them failed, STARTED while one is open."""
        status = F.col("status")
        some = lambda s: F.max(status == s)
        whole = F.when(some(STARTED), STARTED).when(F.min(status == FAILED), FAILED).when(some(FAILED) | some(PARTIAL), PARTIAL).otherwise(SUCCESS)
        return self.frame().groupBy("run_id").agg(whole.alias("status"), F.count(F.when(status == FAILED, 1)).alias("failed_loads"))

    def _append(self, run_id: str, pipeline_id: str, status: str, **values) -> str:
        zero = {"records_extracted": 0, "records_loaded": 0, "records_rejected": 0, "error_message": None}
        record = zero | {"run_id": run_id, "pipeline_id": pipeline_id, "status": status, "at": self.now()} | values
        self.log.append(lambda _: record)
        return record["at"]
