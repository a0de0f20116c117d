"""Merging a stream into a keyed table as it arrives, by copying only what a micro-batch touches.

Rows are stored in buckets by the first bits of their key's hash. A bucket that would hold more than a
given number of rows is split by more bits, so the number of buckets follows the table and the size of one does
not. A micro-batch reads and rewrites the buckets of its own keys: at most as many rows as it has keys
times the size of a bucket, whatever the table holds. The new buckets replace the old ones by one commit
named by the batch, so a replayed batch finds its commit and changes no file.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.session import discard, materialise
from sedimenta.sources.tables import PartitionedTable

MOST_ROWS = 500_000
_BITS = 64
_BUCKET = "_bucket"

Change = Callable[[DataFrame, DataFrame], DataFrame]


def _bits(key: str) -> Column:
    return F.lpad(F.bin(F.xxhash64(key)), _BITS, "0")


class KeyBuckets:
    """A table with one row per key, stored in buckets of at most about ``most_rows`` rows."""

    def __init__(self, spark: SparkSession, root: str, key: str, schema: T.StructType, most_rows: int = MOST_ROWS):
        self.spark = spark
        self.key = key
        self.schema = schema
        self.most_rows = most_rows
        self.table = PartitionedTable(spark, root, _BUCKET)

    def read(self, version: int | None = None) -> DataFrame:
        if not self.table.version():
            return self.spark.createDataFrame([], self.schema)
        return self.table.read(version).select(*self.schema.fieldNames())

    def apply(self, batch: DataFrame, change: Change, run_id: str) -> dict:
        """Replace the buckets of the batch's keys by ``change(rows of those buckets, batch)``.

        ``change`` must keep the keys that the batch does not name. Returns what was read and written; a run that
        was committed before reads and writes nothing.
        """
        if self.table.log.find("number bigint, run_id string", run_id=run_id) is not None:
            return {"rows_read": 0, "buckets_read": 0, "rows_written": 0, "buckets_written": 0}
        version = self.table.version()
        entries = self.table.entries(version)
        touched = self._touched(batch, list(entries)) if entries else []
        stored = self.table.read(version, only=touched).select(*self.schema.fieldNames()) if touched else self.read(0)
        changed = materialise(change(stored, batch).select(*self.schema.fieldNames()), "merged")
        buckets = self._bucketed(changed, touched or [""])
        done = self.table.replace(buckets, run_id, touched=touched, based_on=version, splits=True)
        discard(changed)
        new = self.table.log.get(done)["changed"]
        return {
            "rows_read": sum(entries[b]["rows"] for b in touched), "buckets_read": len(touched),
            "rows_written": sum(e["rows"] for e in new), "buckets_written": len(new)}

    def _touched(self, batch: DataFrame, buckets: list[str]) -> list[str]:
        """The buckets of the batch's keys. A key has as many candidates as there are lengths; one of them exists."""
        lengths = sorted({len(b) for b in buckets})
        candidates = F.explode(F.array(*[F.substring(_bits(self.key), 1, n) if n else F.lit("") for n in lengths]))
        known = self.spark.createDataFrame([(b,) for b in buckets], "b string")
        found = batch.select(candidates.alias("b")).distinct().join(known, "b", "left_semi")
        return sorted(r["b"] for r in found.collect())

    def _bucketed(self, rows: DataFrame, buckets: list[str]) -> DataFrame:
        """Rows with their bucket, cut by more bits where one has become too large."""
        lengths = sorted({len(b) for b in buckets})
        known = self.spark.createDataFrame([(b,) for b in buckets], "_was string")
        bits = _bits(self.key)
        if len(lengths) == 1:
            placed = rows.withColumn("_was", F.substring(bits, 1, lengths[0]) if lengths[0] else F.lit(""))
        else:
            candidates = F.array(*[F.substring(bits, 1, n) if n else F.lit("") for n in lengths])
            placed = rows.withColumn("_was", F.explode(candidates)).join(known, "_was", "left_semi")
        sizes = placed.groupBy("_was").agg(F.count(F.lit(1)).alias("_n"))
        more = F.greatest(F.ceil(F.log2(F.col("_n") / self.most_rows)), F.lit(0)).cast("int")
        depths = sizes.select("_was", F.least(F.length("_was") + more, F.lit(_BITS)).alias("_depth"))
        return placed.join(depths, "_was").withColumn(_BUCKET, bits.substr(F.lit(1), F.col("_depth"))).select(*rows.columns, _BUCKET)

    def fold(self, batch: DataFrame, change: Callable[[DataFrame], DataFrame], run_id: str) -> dict:
        """As ``apply``, with one shuffle: replace the buckets of the batch's keys by ``change`` of their rows and the batch's.

        ``change`` gets both as one frame, in which ``_stored`` tells them apart and the rows of a bucket lie in one
        task; it must leave them there and keep the keys that the batch does not name. Returns what was read and
        written; a run that was committed before reads and writes nothing.
        """
        if self.table.log.find("number bigint, run_id string", run_id=run_id) is not None:
            return {"rows_read": 0, "buckets_read": 0, "rows_written": 0, "buckets_written": 0}
        names = self.schema.fieldNames()
        version = self.table.version()
        entries = self.table.entries(version)
        arriving = self._arriving(batch, list(entries) or [""])
        touched = sorted(arriving) if entries else []
        rows = batch.select(*names).withColumn("_stored", F.lit(False))
        if touched:
            stored = self.table.read(version, only=touched).select(*names).withColumn("_stored", F.lit(True))
            rows = stored.unionByName(rows)
        sizes = {b: n + (entries[b]["rows"] if entries else 0) for b, n in arriving.items()}
        # One shuffle brings a bucket's rows together for both the change and the files.
        placed = self._placed(rows, sizes or {"": 0}).repartition(F.col(_BUCKET))
        done = self.table.replace(
            change(placed).select(*names, _BUCKET), run_id, touched=touched, based_on=version, splits=True, placed=True)
        new = self.table.log.get(done)["changed"]
        return {
            "rows_read": sum(entries[b]["rows"] for b in touched), "buckets_read": len(touched),
            "rows_written": sum(e["rows"] for e in new), "buckets_written": len(new)}

    def _arriving(self, batch: DataFrame, buckets: list[str]) -> dict[str, int]:
        """The buckets of the batch's keys and its rows of each."""
        found = self._in(batch.select(self.key), buckets).groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"))
        return {r[_BUCKET]: r["n"] for r in found.collect()}

    def _placed(self, rows: DataFrame, sizes: dict[str, int]) -> DataFrame:
        """Rows with their bucket, cut by more bits where one may become too large.

        ``sizes`` are the rows of each bucket, a key that is stored and arrives being counted twice.
        """
        buckets = []
        for bucket, size in sizes.items():
            more = min(max(math.ceil(math.log2(max(size, 1) / self.most_rows)), 0), _BITS - len(bucket))
            buckets += [bucket + (f"{n:0{more}b}" if more else "") for n in range(1 << more)]
        return self._in(rows, buckets)

    def _in(self, rows: DataFrame, buckets: list[str]) -> DataFrame:
        """Rows with their bucket. A key has as many candidates as there are lengths; one of them exists."""
        lengths = sorted({len(b) for b in buckets})
        candidates = [F.substring(_bits(self.key), 1, n) if n else F.lit("") for n in lengths]
        if len(lengths) == 1 and len(buckets) == 1 << lengths[0]:
            return rows.withColumn(_BUCKET, candidates[0])
        known = self.spark.createDataFrame([(b,) for b in buckets], f"{_BUCKET} string")
        return rows.withColumn(_BUCKET, F.explode(F.array(*candidates))).join(known, _BUCKET, "left_semi")


class EnvelopeMerge:
    """Change envelopes ``{op, ts_ms, before, after}`` merged into a table in every micro-batch.

    The newest envelope of a key by ``ts_ms`` and ``seq`` wins, in whatever order and batch envelopes arrive: the table
    keeps the place of the last one it has taken, and of a deleted key nothing but that place. Stored rows that no
    envelope has reached yet give way to any.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: str, row: T.StructType, envelopes: T.StructType, seq: list[str],
        most_rows: int = MOST_ROWS,
    ):
        self.key, self.row, self.seq = key, row, ["ts_ms", *seq]
        place = T.StructType([envelopes[s] for s in self.seq])
        schema = T.StructType([*row.fields, T.StructField("_seq", place), T.StructField("_alive", T.BooleanType())])
        self.buckets = KeyBuckets(spark, root, key, schema, most_rows)
        self.progress: dict[int, dict] = {}

    def seed(self, rows: DataFrame) -> None:
        """Store the rows the stream starts from."""
        place = F.lit(None).cast(self.buckets.schema["_seq"].dataType)
        self.buckets.fold(rows.withColumns({"_seq": place, "_alive": F.lit(True)}), lambda rows: rows, "seed")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Handle a micro-batch."""
        newest = self._newest(batch)
        self.progress[batch_id] = self.buckets.fold(newest, self._change, f"batch-{batch_id}")
        discard(newest)

    def read(self) -> DataFrame:
        return self.buckets.read().where("_alive").select(*self.row.fieldNames())

    def _newest(self, batch: DataFrame) -> DataFrame:
        key = F.coalesce(F.col(f"after.{self.key}"), F.col(f"before.{self.key}"))
        image = [F.col(f"after.{c}").alias(c) for c in self.row.fieldNames() if c != self.key]
        flat = batch.select(key.alias(self.key), *image, (F.col("op") != "d").alias("_alive"), F.struct(*self.seq).alias("_seq"))
        # One struct holds the place once; of equal places either row will do.
        rest = [n for n in flat.columns if n not in (self.key, "_seq")]
        newest = flat.groupBy(self.key).agg(F.max(F.struct("_seq", *rest)).alias("_row"))
        return materialise(newest.select(self.key, "_row.*"), "newest")

    def _change(self, rows: DataFrame) -> DataFrame:
        names = self.buckets.schema.fieldNames()
        rest = [n for n in names if n != self.key]
        same = Window.partitionBy(_BUCKET, self.key)
        arrived = F.when(~F.col("_stored") & F.col(self.key).isNotNull(), F.struct(*rest))
        seen = rows.withColumns({"_new": F.first(arrived, ignorenulls=True).over(same), "_known": F.max("_stored").over(same)})
        # An arriving row takes the place of what is stored, or is added; null keys match nothing.
        seen = seen.where(F.col("_stored") | ~F.col("_known") | F.col(self.key).isNull())
        old, new = F.col("_seq"), F.col("_new._seq")
        wins = F.col("_stored") & F.col("_new").isNotNull() & (old.isNull() | (new > old))
        row = F.when(wins, F.col("_new")).otherwise(F.struct(*rest))
        return seen.select(self.key, _BUCKET, row.alias("_row")).select(self.key, _BUCKET, "_row.*")
