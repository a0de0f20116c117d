"""Merging a batch into a table whose storage has no row-level updates.

Every operator returns the complete new state; publish it as a new version. Batches are reduced to
one row per key before any join, so a key that fills a third of the batch is combined map-side.
"Last" never means arrival order: the caller names the sequence columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The row with the greatest sequence of each key."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*seq)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def replace_rows(target: DataFrame, batch: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Whole-row replace: the last batch row of a key wins over the stored one."""
    newest = latest_per_key(batch, keys, seq).select(*target.columns)
    return target.join(newest, keys, "left_anti").unionByName(newest)


def insert_absent(target: DataFrame, rows: DataFrame, keys: list[str], seq: list[str] | None = None) -> DataFrame:
    """Add the rows whose key is not stored yet; stored rows stay as they are.

    Of batch rows with one key the first by ``seq`` is added, by default the least row.
    """
    rest = [c for c in target.columns if c not in keys]
    if rest:
        first = F.min_by(F.struct(*rest), F.struct(*(seq or rest))).alias("_row")
        rows = rows.groupBy(*keys).agg(first).select(*keys, "_row.*")
    else:
        rows = rows.select(*keys).distinct()
    return target.unionByName(rows.select(*target.columns).join(target, keys, "left_anti"))


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], update: list[str], seq: list[str]
) -> DataFrame:
    """Insert new keys whole; of stored keys overwrite only the ``update`` columns.

    Repeated keys inside the batch act as if applied one after the other: the insert takes the
    first row, the update columns come from the last. A batch NULL overwrites. Both sides of the
    outer join hold one row per key, so it cannot be skewed.
    """
    order = F.struct(*seq)
    rest = [c for c in target.columns if c not in keys]
    insert_only = [c for c in rest if c not in update]
    last = F.max_by(F.struct(*update), order).alias("_last")
    first = [F.min_by(F.struct(*insert_only), order).alias("_first")] if insert_only else []
    changes = batch.groupBy(*keys).agg(last, *first).withColumn("_hit", F.lit(True))
    old = target.withColumn("_old", F.lit(True))
    joined = old.join(changes, keys, "full_outer")

    def value(column: str) -> Column:
        if column in update:
            return F.when(F.col("_hit"), F.col(f"_last.{column}")).otherwise(old[column])
        return F.when(F.col("_old"), old[column]).otherwise(F.col(f"_first.{column}"))

    return joined.select(*[c if c in keys else value(c).alias(c) for c in target.columns])


def replace_groups(target: DataFrame, aggregate: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert of an aggregate: recomputed groups replace their rows, groups not in it stay."""
    return target.join(aggregate, keys, "left_anti").unionByName(aggregate.select(*target.columns))
