"""Token vault, erasure and layer projections."""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import privacy
from sedimenta.streaming.merging import MOST_ROWS, KeyBuckets


def split_vault(df: DataFrame, key: str, pii: list[str], pepper: str) -> tuple[DataFrame, DataFrame]:
    """A vault (token to personal data) and the frame with the token in place of key and data."""
    token = privacy.peppered_token(key, pepper).alias(f"{key}_token")
    vault = df.select(token, key, *pii).dropDuplicates([f"{key}_token"])
    return vault, df.select(token, *[c for c in df.columns if c != key and c not in pii])


def erase(vault: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Vault without the persons who asked to be forgotten; their tokens become unlinkable."""
    return vault.join(requests.select(key), key, "left_anti")


class TokenVault:
    """Personal data under random tokens, which stand in its place everywhere else.

    A key gets its token once, from the operating system's source of random bytes, when it is first stored; storing
    it again keeps the token. Nothing derives a token from a key, so once a person is erased, from the vault and from all
    its older versions, nobody can link the tokens left elsewhere. Persons are kept in buckets of keys: a load
    or a request reads and rewrites the buckets of its own keys only.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, row: T.StructType, most_rows: int = MOST_ROWS):
        """``row`` has the key and the personal data that belongs to it."""
        self.key = key
        self.token = f"{key}_token"
        self.pii = [n for n in row.fieldNames() if n != key]
        schema = T.StructType([*row.fields, T.StructField(self.token, T.StringType())])
        self.buckets = KeyBuckets(spark, root, key, schema, most_rows)

    def read(self) -> DataFrame:
        return self.buckets.read()

    def assign(self, persons: DataFrame, run_id: str) -> None:
        """Store persons that are not stored yet, with a token each; of rows with one key the least is stored."""
        rows = persons.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(F.struct(*self.pii)).alias("_p"))
        names = self.buckets.schema.fieldNames()

        def insert(stored: DataFrame, batch: DataFrame) -> DataFrame:
            absent = batch.join(stored, self.key, "left_anti").select(self.key, *self.pii)
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.buckets.schema if f.name != self.token)
            tokened = absent.mapInArrow(_random_tokens(self.token), f"{schema}, `{self.token}` string")
            return stored.select(*names).unionByName(tokened)

        self.buckets.apply(rows.select(self.key, "_p.*"), insert, run_id)

    def tokenise(self, df: DataFrame) -> DataFrame:
        """Rows with the token in place of the key, without the personal data; the key must have been assigned."""
        tokens = self.read().select(self.key, self.token)
        return df.join(tokens, self.key, "left").select(self.token, *[c for c in df.columns if c != self.key and c not in self.pii])

    def erase(self, requests: DataFrame, run_id: str) -> None:
        """Forget persons, also in older versions of the vault; a request that is repeated finds nothing to do."""
        asked = requests.select(self.key).distinct()
        self.buckets.apply(asked, lambda stored, batch: stored.join(batch, self.key, "left_anti"), run_id)
        self.buckets.table.purge()


def _random_tokens(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array([secrets.token_hex(16) for _ in range(batch.num_rows)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], [*batch.schema.names, name])

    return run


def minimise(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Only the allow-listed columns, in their order in the frame."""
    return df.select(*[c for c in df.columns if c in allowed])


#: How columns of these names are masked; the others are replaced by a token.
_MASKS = {
    "email": privacy.mask_email_prefix, "personal_email": privacy.mask_email_prefix, "phone": privacy.mask_phone_national,
    "delivery_address": privacy.mask_address}


def mask_configured(df: DataFrame, pii_columns: list[str], pepper: str | None = None) -> DataFrame:
    """Mask configured columns before landing: addresses and phones readably, the rest by a token.

    Numbers such as social security numbers are few enough to be guessed, so their tokens need a secret.
    """
    present = [c for c in pii_columns if c in df.columns]
    if pepper is None and set(present) - set(_MASKS):
        raise ValueError(f"a pepper is needed for the tokens of {sorted(set(present) - set(_MASKS))}")
    return df.withColumns({c: _MASKS[c](c) if c in _MASKS else privacy.peppered_token(c, pepper) for c in present})
