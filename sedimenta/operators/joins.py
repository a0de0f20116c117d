"""Join patterns: fan-out diagnosis and cure, hierarchies, version numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.money import money


def items_per_order(items: DataFrame) -> DataFrame:
    """Lines reduced to one row per order before any join; combined map-side."""
    return items.groupBy("order_id").agg(
        F.count("*").alias("item_count"), F.sum("total_price").alias("items_sum")
    )


def fan_out(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with several lines: header total against the sum of their lines."""
    several = items_per_order(items).where(F.col("item_count") > 1)
    return orders.join(several, "order_id").select(
        "order_id",
        F.col("total_amount").alias("order_table_total"),
        F.col("items_sum").cast("double").alias("items_sum"),
        "item_count",
    )


def fan_out_effect(orders: DataFrame, items: DataFrame) -> DataFrame:
    """How much summing header totals over joined lines inflates them.

    The joined sum is the header total times the line count, so the lines need not be joined.
    """
    joined = orders.join(items_per_order(items), "order_id")
    total = money("total_amount")
    return joined.agg(
        F.sum(total).cast("double").alias("true_total"),
        F.sum(total * F.col("item_count")).cast("double").alias("inflated_total"),
        F.sum("item_count").alias("joined_rows"),
    )


def next_versions(staging: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Staged rows with the version they would get: highest stored version plus one."""
    highest = dim.groupBy(key).agg(F.max("version").alias("_max"))
    return staging.join(highest, key, "left").withColumn(
        "version", (F.coalesce(F.col("_max"), F.lit(0)) + 1).cast("bigint")
    ).drop("_max")
