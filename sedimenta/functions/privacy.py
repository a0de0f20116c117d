"""Masking, hashing, tokenising and encrypting personal data as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns that must not reach the gold layer.
DIRECT_PII = ("email", "phone", "first_name", "last_name", "ssn")


def mask_email_short(col: str) -> Column:
    """First character, ``***@``, domain. Anything but exactly one ``@`` is masked whole."""
    parts = F.split(F.col(col), "@")
    return F.when(
        F.size(parts) == 2, F.concat(F.substring(parts[0], 1, 1), F.lit("***@"), parts[1])
    ).otherwise("***@example.com")


def mask_email_prefix(col: str) -> Column:
    """First two characters, ``***@``, everything after the first ``@``."""
    c = F.col(col)
    at = F.instr(c, "@")
    user = F.substring_index(c, "@", 1)
    return F.when(
        at > 0, F.concat(F.substring(user, 1, 2), F.lit("***@"), F.substring(c, at + 1, F.length(c)))
    ).otherwise("***@masked.com")


def mask_email_ends(col: str) -> Column:
    """First and last character of the local part around ``***``, then the domain."""
    c = F.col(col)
    at = F.instr(c, "@")
    user = F.substring_index(c, "@", 1)
    return F.when(
        at > 1,
        F.concat(
            F.substring(user, 1, 1), F.lit("***"), F.right(user, F.lit(1)), F.lit("@"),
            F.substring(c, at + 1, F.length(c)),
        ),
    ).otherwise("***@example.com")


def mask_phone_short(col: str) -> Column:
    """Six stars and the last four characters, or only the stars."""
    c = F.coalesce(F.col(col), F.lit(""))
    return F.when(F.length(c) >= 4, F.concat(F.lit("******"), F.right(c, F.lit(4)))).otherwise("******")


def mask_phone_national(col: str) -> Column:
    c = F.coalesce(F.col(col), F.lit(""))
    return F.when(F.length(c) >= 10, F.concat(F.lit("+91XXXXXX"), F.right(c, F.lit(4)))).otherwise(
        "+91XXXXXXXXXX"
    )


def mask_address(col: str) -> Column:
    """What follows the first comma, which names the town; an address without one is masked whole."""
    c = F.col(col)
    rest = F.substring(c, F.instr(c, ",") + 1, F.length(c))
    return F.when(F.instr(c, ",") > 0, F.concat(F.lit("***,"), rest)).otherwise(F.when(c.isNotNull(), "***"))


def sha256(col: str) -> Column:
    return F.sha2(F.col(col).cast("string"), 256)


def peppered_token(col: str, pepper: str) -> Column:
    """Pseudonym of an identifier. The pepper comes from configuration, never from the data."""
    return F.sha2(F.concat_ws("_", F.coalesce(F.col(col).cast("string"), F.lit("")), F.lit(pepper)), 256)


def encrypt(col: str, key: str) -> Column:
    return F.base64(F.aes_encrypt(F.col(col), F.lit(key)))


def decrypt(col: str, key: str) -> Column:
    return F.aes_decrypt(F.unbase64(F.col(col)), F.lit(key)).cast("string")
