"""Slowly changing dimensions: overwrite, full history, previous value, and history checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators import ordered
from sedimenta.operators.merge import latest_per_key
from sedimenta.session import materialise


def overwrite(dim: DataFrame, changes: DataFrame, key: str, columns: list[str], seq: list[str]) -> DataFrame:
    """Type 1: new values in all versions of the key; version numbers and row count stay."""
    newest = latest_per_key(changes, [key], seq).select(
        key, F.struct(*columns).alias("_new"), F.lit(True).alias("_hit")
    )
    joined = dim.join(newest, key, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(dim[c]).alias(c) if c in columns else dim[c]
        for c in dim.columns
    ])


def merge_history(
    dim: DataFrame, staging: DataFrame, key: str, attributes: list[str], as_of: str, seq: list[str],
    detect_changes: bool = False,
) -> DataFrame:
    """Type 2: expire the current version of every staged key and add version max + 1.

    Staging is reduced to the latest row per key. Without ``detect_changes`` a staged key always
    gets a new version, even when nothing differs.
    """
    today = F.lit(as_of).cast("date")
    staged = latest_per_key(staging, [key], seq).select(key, *attributes)
    if detect_changes:
        current = dim.where(F.col("is_current") == 1).select(
            key, F.struct(*attributes).alias("_current"), F.lit(1).alias("_known")
        )
        same = F.coalesce(F.col("_known") == 1, F.lit(False)) & F.struct(*attributes).eqNullSafe(F.col("_current"))
        staged = staged.join(current, key, "left").where(~same).select(key, *attributes)

    touched = staged.select(key, F.lit(True).alias("_staged"))
    expired = F.coalesce(F.col("_staged"), F.lit(False)) & (F.col("is_current") == 1)
    kept = dim.join(touched, key, "left").select(*[_expire(c, expired, today) for c in dim.columns])

    versions = dim.groupBy(key).agg(F.max("version").alias("_max"))
    added = staged.join(versions, key, "left").select(
        key, *attributes,
        today.alias("effective_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(1).alias("is_current"),
        (F.coalesce(F.col("_max"), F.lit(0)) + 1).cast("bigint").alias("version"),
    )
    return kept.unionByName(added)


def _expire(column: str, expired: Column, today: Column) -> Column:
    if column == "expiry_date":
        return F.when(expired, today).otherwise(F.col(column)).alias(column)
    if column == "is_current":
        return F.when(expired, 0).otherwise(F.col(column)).alias(column)
    return F.col(column)


def rebuild_history(log: DataFrame, key: str, effective: str, tiebreak: list[str], buckets: int | None = None) -> DataFrame:
    """Type 2 from a change log: one version per log row, each ending where the next begins.

    The log of one key may be arbitrarily long; it is cut into ranges rather than sent to one task.
    """
    versions = ordered.ordered_window(
        materialise(log, "change-log"),
        {"version": ordered.row_number(), "expiry_date": ordered.lead(effective)},
        partition_by=[key], order_by=[(effective, "asc")], tiebreak=tiebreak, buckets=buckets,
    )
    return versions.withColumn("is_current", F.when(F.col("expiry_date").isNull(), 1).otherwise(0))


def insert_versions(
    dim: DataFrame, late: DataFrame, key: str, attributes: list[str], surrogate: str, seq: list[str], buckets: int | None = None
) -> DataFrame:
    """Type 2: versions that become known after later ones.

    ``late`` holds the key, ``effective_date``, the attributes and the surrogate key of the new version; of several rows with one key and
    date the last by ``seq`` counts. The version that covers the date ends there, the new one lasts until the next begins (or
    until the covering one ended), and the versions of the key are numbered anew. A stored version that begins on the same day
    keeps its surrogate key and interval and takes the new attributes. Other keys pass untouched, so only the histories of late
    keys are put in order. ``dim`` should be a table; it is read several times.
    """
    staged = latest_per_key(late.select(key, "effective_date", *attributes, surrogate, *[s for s in seq if s not in late.columns]),
                            [key, "effective_date"], seq)
    touched = dim.join(staged.select(key).distinct(), key, "left_semi")
    new = staged.select(key, "effective_date", F.struct(*attributes).alias("_new"), F.col(surrogate).alias("_sk"), F.lit(True).alias("_late"))
    both = touched.join(new, [key, "effective_date"], "full_outer")
    rest = [c for c in dim.columns if c not in (key, "effective_date", "expiry_date", "is_current", "version")]
    inserted = F.col("version").isNull()

    def value(c: str) -> Column:
        if c == surrogate:
            return F.when(inserted, F.col("_sk")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_late"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c)

    # The end of a stored version, also where it is open; of a new one, that of the stored version before it.
    stored_end = F.when(~inserted, F.struct(F.col("expiry_date").alias("at")))
    merged = materialise(both.select(key, "effective_date", *[value(c) for c in rest], stored_end.alias("_end"), inserted.alias("_inserted")), "versions")
    placed = ordered.ordered_window(
        merged,
        {"version": ordered.row_number(), "_next": ordered.lead("effective_date"), "_covering": ordered.carry_forward("_end")},
        partition_by=[key], order_by=[("effective_date", "asc")], tiebreak=[], buckets=buckets)
    end = F.col("_covering.at")
    own = F.when(~F.col("_inserted") | (end > F.col("effective_date")), end)
    again = placed.withColumn("expiry_date", F.least(F.col("_next"), own)).withColumn(
        "is_current", F.when(F.col("expiry_date").isNull(), 1).otherwise(0))
    names = [F.col(c).cast(dim.schema[c].dataType).alias(c) for c in dim.columns]
    return dim.join(staged.select(key).distinct(), key, "left_anti").select(*dim.columns).unionByName(again.select(*names))


def shift_previous(dim: DataFrame, changes: DataFrame, key: str, column: str, previous: str, seq: list[str]) -> DataFrame:
    """Type 3: on a change the old value moves to ``previous``; equal values change nothing."""
    newest = latest_per_key(changes, [key], seq).select(key, F.struct(column).alias("_new"))
    joined = dim.join(newest, key, "left")
    changed = F.col("_new").isNotNull() & ~F.col(f"_new.{column}").eqNullSafe(dim[column])
    moved = {
        column: F.when(changed, F.col(f"_new.{column}")).otherwise(dim[column]),
        previous: F.when(changed, dim[column]).otherwise(dim[previous]),
    }
    return joined.select(*[moved[c].alias(c) if c in moved else dim[c] for c in dim.columns])


def validate_history(dim: DataFrame, key: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Violations of a type 2 table: current rows per key, version numbering, gaps and overlaps."""
    dim = materialise(dim.select(key, "version", "effective_date", "expiry_date", "is_current"), "history")
    per_key = dim.groupBy(key).agg(
        F.sum("is_current").alias("_current"),
        F.count("*").alias("_n"),
        F.min("version").alias("_min"),
        F.max("version").alias("_max"),
    )
    distinct = dim.groupBy(key, "version").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    follow = ordered.ordered_window(
        dim, {"_next": ordered.lead("effective_date")},
        partition_by=[key], order_by=[("version", "asc")], tiebreak=tiebreak or ["effective_date"],
    )
    gap = F.col("_next").isNotNull() & ~F.col("expiry_date").eqNullSafe(F.col("_next"))
    checks = [
        ("current_rows_per_key", per_key, F.col("_current") != 1),
        ("version_range", per_key, (F.col("_min") != 1) | (F.col("_max") != F.col("_n"))),
        ("duplicate_versions", distinct, F.lit(True)),
        ("gap_or_overlap", follow, gap),
    ]
    parts = [
        df.agg(F.count(F.when(bad, 1)).alias("violation_count")).select(F.lit(name).alias("check_name"), "violation_count")
        for name, df, bad in checks
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def as_of_lookup(
    facts: DataFrame, history: DataFrame, key: str, fact_date: str, columns: list[str], tiebreak: list[str],
    buckets: int | None = None,
) -> DataFrame:
    """The dimension version valid on each fact's date (half-open interval), NULL where none is.

    Facts and versions are merged into one sequence per key and each fact takes the last version
    before it. That is linear in the rows of a key, where an equi-join with a range condition would
    pair all its facts with all its versions. ``facts`` should be a table; it is read several times.
    """
    history = materialise(history.select(key, "effective_date", "expiry_date", *columns), "versions")
    payload = F.struct(F.col("effective_date").alias("_from"), F.col("expiry_date").alias("_to"), *columns)
    fact_fields = [c for c in facts.columns if c != key]
    versions = history.select(
        key, F.col("effective_date").alias("_at"), F.lit(0).alias("_kind"), payload.alias("_version"),
        F.lit(None).cast(facts.select(F.struct(*fact_fields)).schema[0].dataType).alias("_fact"),
        *[F.lit(None).cast(facts.schema[t].dataType).alias(f"_t_{t}") for t in tiebreak],
    )
    rows = facts.select(
        key, F.col(fact_date).cast("date").alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
        F.struct(*fact_fields).alias("_fact"),
        *[F.col(t).alias(f"_t_{t}") for t in tiebreak],
    )
    filled = ordered.ordered_window(
        versions.unionByName(rows),
        {"_valid": ordered.carry_forward("_version")},
        partition_by=[key], order_by=[("_at", "asc"), ("_kind", "asc")],
        tiebreak=[f"_t_{t}" for t in tiebreak], buckets=buckets,
    )
    open_then = F.col("_valid._to").isNull() | (F.col("_at") < F.col("_valid._to"))
    return (
        filled.where(F.col("_kind") == 1)
        .withColumn("_valid", F.when(open_then, F.col("_valid")))
        .select(key, "_fact.*", *[F.col(f"_valid.{c}").alias(c) for c in columns])
        .select(*facts.columns, *columns)
    )
