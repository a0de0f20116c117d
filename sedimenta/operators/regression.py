"""Comparing an output with a golden table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_to_golden(actual: DataFrame, golden: DataFrame) -> DataFrame:
    """One verdict row: row counts, rows missing, rows unexpected (as multisets).

    Grouping the counts of either side combines equal rows before the shuffle, so a row that
    repeats very often does not load one task, and both directions cost one shuffle together.
    """
    columns = golden.columns
    signed = actual.select(*columns, F.lit(1).alias("_sign")).unionByName(
        golden.select(*columns, F.lit(-1).alias("_sign"))
    )
    per_row = signed.groupBy(*columns).agg(
        F.sum(F.when(F.col("_sign") > 0, 1).otherwise(0)).alias("_a"),
        F.sum(F.when(F.col("_sign") < 0, 1).otherwise(0)).alias("_g"),
    )
    verdict = per_row.agg(
        F.coalesce(F.sum("_a"), F.lit(0)).cast("bigint").alias("actual_rows"),
        F.coalesce(F.sum("_g"), F.lit(0)).cast("bigint").alias("golden_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_g") - F.col("_a"), F.lit(0))), F.lit(0)).cast("bigint").alias("missing_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_a") - F.col("_g"), F.lit(0))), F.lit(0)).cast("bigint").alias("unexpected_rows"),
    )
    return verdict.withColumn(
        "status",
        F.when((F.col("missing_rows") == 0) & (F.col("unexpected_rows") == 0), "PASSED").otherwise("FAILED"),
    )
