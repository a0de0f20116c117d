"""Physical layout: date partitions, multi-column clustering, plan profiles, refresh by group."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.merge import upsert
from sedimenta.sources.tables import PartitionedTable


def write_by_month(df: DataFrame, ts: str, path: str) -> None:
    """``year=/month=`` directories; both have few values, so file counts stay low.

    Rebalancing gathers a month in few files and lets AQE split a month too large for one task.
    """
    dated = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    dated.hint("rebalance", F.col("year"), F.col("month")).write.partitionBy("year", "month").parquet(path)


def z_value(columns: list[str], limits: dict[str, tuple[float, float]], bits: int = 16) -> Column:
    """Interleaved bits of the columns, each scaled to ``2**bits`` steps between its limits; 62 bits at most in all."""
    bits = min(bits, 62 // len(columns))
    cells = []
    for c in columns:
        low, high = limits[c]
        step = F.floor((F.col(c).cast("double") - low) / max(high - low, 1e-9) * (2**bits - 1))
        cells.append(F.least(F.greatest(step, F.lit(0)), F.lit(2**bits - 1)).cast("bigint"))
    value = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            taken = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            value = value.bitwiseOR(F.shiftleft(taken, bit * len(cells) + i))
    return value


def write_clustered(df: DataFrame, columns: list[str], path: str, rows_per_file: int = 1_000_000, least_files: int = 16) -> None:
    """Cluster by z-value: neighbours in all columns share files, so min/max statistics prune.

    A row hash follows the z-value in the range key, so a cell with very many rows is spread over
    several files. Their number follows the rows.
    """
    stats = df.agg(*[f(F.col(c).cast("double")) for c in columns for f in (F.min, F.max)], F.count(F.lit(1))).first()
    files = max(least_files, math.ceil(stats[-1] / rows_per_file))
    limits = {c: (stats[2 * i], stats[2 * i + 1]) for i, c in enumerate(columns)}
    (
        df.withColumns({"_z": z_value(columns, limits), "_row": F.xxhash64(*df.columns)})
        .repartitionByRange(files, "_z", "_row")
        .sortWithinPartitions("_z")
        .drop("_z", "_row")
        .write.parquet(path)
    )


def cluster_overlap(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: mean share of the value range one stored file spans (smaller prunes better)."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[(F.max(c) - F.min(c)).cast("double").alias(f"span_{c}") for c in columns],
        *[F.min(c).cast("double").alias(f"min_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"max_{c}") for c in columns],
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"),
                 (F.avg(f"span_{c}") / (F.max(f"max_{c}") - F.min(f"min_{c}"))).alias("mean_span"))
        for c in columns
    ]
    return per_file.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("r")).select("r.*")


def plan_profile(df: DataFrame, label: str) -> DataFrame:
    """Scan facts of a plan as a row: partition filters, pushed filters, columns read, files read."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )

    def line(name: str) -> str:
        found = re.findall(rf"^{name}: (.*)$", plan, re.MULTILINE)
        return " | ".join(found)

    return df.sparkSession.createDataFrame(
        [(label, line("PartitionFilters"), line("PushedFilters"), line("ReadSchema"), len(df.inputFiles()))],
        "layout string, partition_filters string, pushed_filters string, read_schema string, files_listed int",
    )


class MovedKeys(ValueError):
    """Batch rows whose key is stored in another partition."""


def upsert_partitions(
    table: PartitionedTable, batch: DataFrame, keys: list[str], update: list[str], seq: list[str], run_id: str,
    keys_move: bool = True,
) -> DataFrame:
    """Upsert that reads and rewrites only the partitions the batch touches; the table as of its commit.

    A key that is stored in another partition than the batch says would be stored twice, so it raises
    ``MovedKeys``. To find it the key columns of all other partitions are read; with ``keys_move=False`` the caller
    states that a key keeps its partition, as with orders stored by their date, and they are not. The
    partition values brought to the driver are at most as many as the table has directories.
    """
    version = table.version()
    touched = [r[0] for r in batch.select(F.col(table.partition).cast("string")).distinct().collect()]
    current = table.read(version, only=touched) if version else batch.limit(0)
    partition = table.partition
    if keys_move and version:
        homes = batch.select(*keys, F.col(partition).cast("string").alias("_to")).distinct()
        stored = table.read(version).select(*keys, F.col(partition).cast("string").alias("_at"))
        moved = homes.join(stored, keys).where(~F.col("_at").eqNullSafe(F.col("_to")))
        found = moved.select(*keys).limit(5).collect()
        if found:
            raise MovedKeys(f"keys are stored in other partitions: {[tuple(r) for r in found]}")
    done = table.replace(upsert(current, batch, keys, update, seq), run_id, touched=touched, based_on=version)
    return table.read(done)


def refresh_groups(table: PartitionedTable, recomputed: DataFrame, run_id: str, touched: list | None = None) -> DataFrame:
    """Replace the partitions of ``recomputed`` by one commit and return the refreshed table.

    Nothing is overwritten: a reader of the version before keeps its files. A partition in ``touched`` for which nothing was
    recomputed is dropped. A repeated refresh changes nothing.
    """
    return table.read(table.replace(recomputed, run_id, touched=touched))
