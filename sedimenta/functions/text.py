"""Standardising and validating text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reasons written next to rejected rows.
INVALID_EMAIL = "INVALID_EMAIL"
NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
MISSING_PK = "MISSING_PK"
FK_VIOLATION = "FK_VIOLATION"
SCHEMA_DRIFT = "SCHEMA_DRIFT"
DATA_QUALITY_FAILURE = "DATA_QUALITY_FAILURE"


def clean(col: str) -> Column:
    return F.trim(F.col(col))


def clean_lower(col: str) -> Column:
    return F.lower(F.trim(F.col(col)))


def clean_upper(col: str) -> Column:
    return F.upper(F.trim(F.col(col)))


def full_name(first: str, last: str) -> Column:
    """First and last name with one blank; a missing part is left out."""
    return F.concat_ws(" ", F.col(first), F.col(last))


def email_shape_ok(col: str) -> Column:
    """NULL for a NULL address, as in SQL."""
    return F.col(col).like("%@%.%")


def has_at(col: str) -> Column:
    """Never NULL: a missing address has no ``@``."""
    return F.coalesce(F.col(col).contains("@"), F.lit(False))


def validity_flag(email: str, key: str) -> Column:
    return F.when(email_shape_ok(email) & F.col(key).isNotNull(), 1).otherwise(0)


def validity_note(email: str, key: str) -> Column:
    """A NULL address matches neither pattern test, so it stays ``CLEAN`` though its flag is 0."""
    return (
        F.when(~email_shape_ok(email), "INVALID_EMAIL_FORMAT")
        .when(F.col(key).isNull(), "MISSING_CUSTOMER_ID")
        .otherwise("CLEAN")
    )


def missing(col: str) -> Column:
    """NULL or empty text."""
    return F.col(col).isNull() | (F.col(col).cast("string") == "")
