"""Restartable incremental loads by watermark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.sources.tables import LandingTable, WatermarkControl


@dataclass(frozen=True)
class LoadResult:
    """Control values of one run; the rows stay in the table."""

    pipeline_id: str
    run_id: str
    extracted: int
    loaded: int
    rejected: int
    previous_watermark: str
    new_watermark: str


def incremental_load(
    source: DataFrame | Callable[[str, str | None], DataFrame],
    target: LandingTable,
    control: WatermarkControl,
    *,
    pipeline_id: str,
    run_id: str,
    watermark_column: str,
    reason: Column,
    advance_over_rejects: bool = False,
    until: str | None = None,
) -> LoadResult:
    """Load the rows newer than the stored watermark.

    ``source`` may be a function of the watermark and ``until`` that reads no more than it must, where the scan cannot
    see the watermark column itself; the exact filter follows in any case.

    Without ``until`` the watermark becomes the greatest time among the *valid* rows, so rejected
    rows newer than it are read again; ``advance_over_rejects`` changes that. With ``until`` the
    interval is closed at that time and the watermark becomes ``until``. It does not move when nothing was loaded.

    The rows are written first, then the run is recorded with its watermark in one commit, then the rows become
    visible. Repeating a recorded run returns the recorded result and changes no rows; if the run died in
    between, the repeat makes them visible. Of two runs that load the same interval at once the second is
    refused by ``ConcurrentCommit``, and its rows stay unseen.
    """
    if (done := control.recorded(pipeline_id, run_id)) is not None:
        if done["landed"]:
            target.commit(done["landed"])
        return LoadResult(**{f.name: done[f.name] for f in fields(LoadResult)})
    position, previous = control.position(pipeline_id)
    moment = F.col(watermark_column)
    rows = source(previous, until) if callable(source) else source
    delta = rows.where(moment > F.lit(previous).cast("timestamp_ntz"))
    if until is not None:
        delta = delta.where(moment <= F.lit(until).cast("timestamp_ntz"))
    routed = delta.withColumn("reason_code", reason)
    counted = moment if advance_over_rejects else F.when(F.col("reason_code").isNull(), moment)
    metrics, landed = target.stage(routed, run_id, F.max(counted).cast("string").alias("newest"))
    moved = metrics["extracted"] if advance_over_rejects else metrics["loaded"]
    new = previous
    if until is not None:
        new = until if metrics["extracted"] else previous
    elif moved:
        new = metrics["newest"]
    result = LoadResult(
        pipeline_id, run_id, metrics["extracted"], metrics["loaded"], metrics["rejected"], previous, new
    )
    control.record(asdict(result) | {"landed": landed}, after=position)
    target.commit(landed)
    return result
