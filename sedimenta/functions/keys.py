"""Surrogate keys that need no coordination between tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = -1


def hash_key(*cols: str, length: int = 12) -> Column:
    """Prefix of the SHA-256 of the ``_``-joined values.

    Twelve hex digits are 48 bits; pass ``length=64`` above some millions of keys.
    """
    return F.substring(F.sha2(F.concat_ws("_", *[F.col(c).cast("string") for c in cols]), 256), 1, length)


def or_unknown(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(UNKNOWN_KEY).cast("bigint"))


def number_key(*cols: str) -> Column:
    """Deterministic non-negative bigint key: the first 60 bits of the same SHA-256.

    Needs no running maximum, so parallel loads cannot hand out the same key twice; -1 stays free
    for the unknown member. Check collisions with the duplicate-key rule.
    """
    return F.conv(hash_key(*cols, length=15), 16, 10).cast("bigint")
