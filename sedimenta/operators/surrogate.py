"""Surrogate keys that loads hand out together: checked hashes and reserved ranges.

Both keep their state in commits that are created only if absent, so two loads at once never give one key to two
members, and a load that is repeated gets the keys it got before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import ordered
from sedimenta.session import materialise
from sedimenta.sources.commits import MOST_TRIES, CommitLog, ConcurrentCommit
from sedimenta.sources.tables import AppendTable

#: Digits of a hash that fit a non-negative bigint.
_MOST_DIGITS = 15
#: Keys are lengthened by a digit after so many hashes of a member were all taken.
_HASHES_PER_LENGTH = 8


class KeyTable:
    """Business keys with a surrogate key each, kept across loads; no two share one.

    A new member gets the first bits of its hash. If another member has that key, stored or new, the hash of the
    member and a number is tried instead. Which of several new members keeps the key does not depend on task order.
    """

    def __init__(self, spark: SparkSession, root: str, business: list[str], surrogate: str, length: int = _MOST_DIGITS):
        self.spark = spark
        self.business = business
        self.surrogate = surrogate
        self.length = length
        self.table = AppendTable(spark, root)

    def read(self) -> DataFrame:
        return self.table.read()

    def assign(self, members: DataFrame, run_id: str) -> DataFrame:
        """The keys of ``members``; those not stored yet are given one. Business keys must not be null."""
        wanted = members.select(*self.business).distinct()
        for _ in range(MOST_TRIES):
            position = self.table.log.last_number()
            new = self._new(wanted, self.read() if position else None)
            try:
                if not position or not new.isEmpty():
                    self.table.append(new, f"{run_id}@{position}", expected=position)
                return self.read().join(wanted, self.business, "left_semi")
            except ConcurrentCommit:
                continue  # another load has stored keys: look again what is new
        raise ConcurrentCommit(f"no commit after {MOST_TRIES} tries in {self.table.root}")

    def _new(self, wanted: DataFrame, stored: DataFrame | None) -> DataFrame:
        pending = materialise(wanted if stored is None else wanted.join(stored, self.business, "left_anti"), "new-members")
        given = [] if stored is None else [stored.select(self.surrogate)]
        found: list[DataFrame] = []
        attempt = 0
        while attempt == 0 or not pending.isEmpty():
            tried = pending.withColumn(self.surrogate, self._hash(attempt))
            # Of new members with one hash the least business key keeps it.
            firsts = tried.groupBy(self.surrogate).agg(F.min(F.struct(*self.business)).alias("_m")).select("_m.*", self.surrogate)
            for taken in given:
                firsts = firsts.join(taken, self.surrogate, "left_anti")
            settled = materialise(firsts.select(*self.business, self.surrogate), "keys")
            found.append(settled)
            given.append(settled.select(self.surrogate))
            pending = materialise(pending.join(settled, self.business, "left_anti"), "colliding")
            attempt += 1
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def _hash(self, attempt: int):
        digits = min(self.length + attempt // _HASHES_PER_LENGTH, _MOST_DIGITS)
        again = [F.lit(str(attempt))] if attempt else []
        text = F.concat_ws("_", *[F.col(c).cast("string") for c in self.business], *again)
        return F.conv(F.substring(F.sha2(text, 256), 1, digits), 16, 10).cast("bigint")


class KeyRanges:
    """Dense keys for any number of writers: a load reserves its range before it writes."""

    def __init__(self, spark: SparkSession, root: str):
        self.log = CommitLog(spark, f"{root}/_ranges")

    def reserve(self, count: int, run_id: str) -> int:
        """The first of ``count`` keys that no other load gets; a load that is repeated gets its range again."""
        for _ in range(MOST_TRIES):
            number, last = self.log.last()
            done = self.log.find("number bigint, run_id string, first bigint, count bigint", run_id=run_id)
            if done is not None:
                if done["count"] != count:
                    raise ValueError(f"{run_id} has reserved {done['count']} keys, not {count}")
                return done["first"]
            first = 1 if last is None else last["first"] + last["count"]
            if self.log.put(number + 1, {"run_id": run_id, "first": first, "count": count}):
                return first
        raise ConcurrentCommit(f"no range after {MOST_TRIES} tries in {self.log.path}")

    def number(self, rows: DataFrame, order: list[str], surrogate: str, run_id: str) -> DataFrame:
        """Rows with consecutive keys in the given order, which must be unique; ``rows`` should be a table."""
        first = self.reserve(rows.count(), run_id)
        numbered = ordered.ordered_window(
            rows, {"_n": ordered.row_number()}, order_by=[(c, "asc") for c in order], tiebreak=[])
        return numbered.withColumn(surrogate, F.col("_n") + F.lit(first - 1)).drop("_n")

