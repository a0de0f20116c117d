"""Row-level rules, dead-letter routing, error classes and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import text

# Error codes, reasons and handling classes.
REASON_NEGATIVE = "ERR_NEG_AMOUNT: Amount must be non-negative"
REASON_EMAIL = "ERR_INVALID_EMAIL: Email missing @ domain"
ERROR_CLASSES = {
    "HTTP_429": ("TRANSIENT", "RETRY"),
    "HTTP_503": ("TRANSIENT", "RETRY"),
    "TIMEOUT": ("TRANSIENT", "RETRY"),
    "INVALID_EMAIL": ("DATA", "QUARANTINE"),
    "NEGATIVE_AMOUNT": ("DATA", "QUARANTINE"),
    "MISSING_PK": ("DATA", "QUARANTINE"),
    "FK_VIOLATION": ("DATA", "QUARANTINE"),
    "DATA_QUALITY_FAILURE": ("DATA", "QUARANTINE"),
    "SCHEMA_DRIFT": ("SCHEMA", "HALT"),
    "MISSING_COLUMN": ("SCHEMA", "HALT"),
}


def first_reason(rules: dict[str, Column]) -> Column:
    """Code of the first violated rule, NULL for a valid row."""
    return F.coalesce(*[F.when(bad, code) for code, bad in rules.items()])


def all_reasons(rules: dict[str, Column]) -> Column:
    """Every violated rule's text, joined with ``"; "``; empty for a valid row."""
    return F.concat_ws("; ", *[F.when(bad, reason) for reason, bad in rules.items()])


def invalid_email(col: str = "email") -> Column:
    return ~text.has_at(col)


def negative(col: str) -> Column:
    """A missing amount counts as zero."""
    return F.coalesce(F.col(col), F.lit(0)) < 0


def lab_rules(email: str, amount: str) -> dict[str, Column]:
    return {REASON_NEGATIVE: negative(amount), REASON_EMAIL: invalid_email(email)}


def keep_usable_customers(df: DataFrame, key: str = "customer_id", email: str = "email") -> DataFrame:
    """Drop rows without key or address; zero and empty text count as missing."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != 0) & ~text.missing(email))


def keep_usable_orders(df: DataFrame, key: str = "order_id", amount: str = "total_amount") -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(amount) >= 0))


def quarantine(
    rejected: DataFrame, *, run_id: str, pipeline_id: str, run_ts: str, details: str,
    payload: list[str] | None = None, reason: str = "reason_code",
) -> DataFrame:
    """Dead-letter records: the row as JSON plus why, where and when it was rejected."""
    columns = payload or [c for c in rejected.columns if c != reason]
    return rejected.select(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline_id).alias("pipeline_id"),
        F.to_json(F.struct(*columns)).alias("raw_payload"),
        F.col(reason).alias("reason_code"),
        F.lit(details).alias("error_details"),
        F.lit(run_ts).cast("timestamp_ntz").alias("created_at"),
    )


def classify(rejects: DataFrame, reason: str = "reason_code") -> DataFrame:
    """Add error class and action; an unknown code stops the load."""
    error_class, action = F.lit("SCHEMA"), F.lit("HALT")
    for code, (klass, what) in ERROR_CLASSES.items():
        error_class = F.when(F.col(reason) == code, klass).otherwise(error_class)
        action = F.when(F.col(reason) == code, what).otherwise(action)
    return rejects.withColumns({"error_class": error_class, "action": action})


def reject_report(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("pipeline_id", "reason_code").agg(F.count("*").alias("reject_count"))


def corrected_negatives(rejects: DataFrame, payload_schema: str, amount: str) -> DataFrame:
    """Parsed payloads of the NEGATIVE_AMOUNT rejects with the sign put right.

    Payloads without an amount cannot be corrected and stay in quarantine.
    """
    parsed = rejects.where(F.col("reason_code") == text.NEGATIVE_AMOUNT).select(
        F.from_json("raw_payload", payload_schema).alias("_p")
    )
    return parsed.select("_p.*").where(F.col(amount).isNotNull()).withColumn(amount, F.abs(amount))


def mark_replayed(rejects: DataFrame, payload_schema: str, amount: str, replay_ts: str) -> DataFrame:
    """Quarantine after a replay: corrected records carry its time, the others stay open."""
    parsed = F.from_json("raw_payload", payload_schema)
    corrected = (F.col("reason_code") == text.NEGATIVE_AMOUNT) & parsed[amount].isNotNull()
    return rejects.withColumn("replayed_at", F.when(corrected, F.lit(replay_ts).cast("timestamp_ntz")))


def distinct_rejects(rejects: DataFrame) -> DataFrame:
    """One record per payload and reason, from the first run that saw it.

    A watermark that follows valid rows only reads newer rejects again in every run.
    """
    first = F.min_by(F.struct("run_id", "raw_payload", "error_details", "created_at"), F.struct("created_at", "run_id"))
    hashed = rejects.withColumn("payload_hash", F.sha2("raw_payload", 256))
    return hashed.groupBy("pipeline_id", "reason_code", "payload_hash").agg(
        first.alias("_r"), F.count("*").alias("seen")
    ).select("pipeline_id", "reason_code", "payload_hash", "seen", "_r.*")


def check_foreign_key(rows: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows with a ``reason_code`` for those without a parent, in one pass; route them afterwards."""
    parents = parent.select(F.col(parent_key).alias(key)).distinct().withColumn("_parent", F.lit(True))
    orphan = F.when(F.col("_parent").isNull(), text.FK_VIOLATION)
    return rows.join(parents, key, "left").withColumn("reason_code", orphan).select(*rows.columns, "reason_code")
