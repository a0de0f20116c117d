"""Statistics from Parquet footers: which row groups a range filter would skip, without reading any data."""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = (
    "file string, row_group int, first_row bigint, rows bigint, column_name string, low double, high double, "
    "low_text string, high_text string, nulls bigint"
)
_ARROW = pa.schema([
    ("file", pa.string()), ("row_group", pa.int32()), ("first_row", pa.int64()), ("rows", pa.int64()), ("column_name", pa.string()),
    ("low", pa.float64()), ("high", pa.float64()), ("low_text", pa.string()), ("high_text", pa.string()), ("nulls", pa.int64())])

_FILES_PER_TASK = 64
_EPOCH = datetime.datetime(1970, 1, 1)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and top-level column; the footers are read by the executors.

    Numbers, dates (days) and times (microseconds) are given as doubles, rounded outwards where a double cannot hold them, so
    a range that misses the bounds misses the rows. Columns without statistics have null bounds.
    """
    files = spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")
    tasks = max(1, math.ceil(files.count() / _FILES_PER_TASK))
    return files.repartition(tasks, "file").mapInArrow(_read_footers, _SCHEMA)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("file").to_pylist():
            fs, path = pafs.FileSystem.from_uri(uri)
            with fs.open_input_file(path) as file:
                yield pa.RecordBatch.from_pylist(list(_groups(uri, pq.ParquetFile(file).metadata)), _ARROW)


def _groups(uri: str, footer: pq.FileMetaData) -> Iterator[dict]:
    first = 0
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            if "." in column.path_in_schema:
                continue
            s = column.statistics
            bounds = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
            text = isinstance(bounds[0], str)
            low, high = (None, None) if text else (_double(bounds[0], -math.inf), _double(bounds[1], math.inf))
            yield {
                "file": uri, "row_group": g, "first_row": first, "rows": group.num_rows, "column_name": column.path_in_schema,
                "low": low, "high": high, "low_text": bounds[0] if text else None, "high_text": bounds[1] if text else None,
                "nulls": s.null_count if s is not None and s.has_null_count else None}
        first += group.num_rows


def _double(value, outwards: float) -> float | None:
    if isinstance(value, datetime.datetime):
        value = (value.replace(tzinfo=None) - _EPOCH) // datetime.timedelta(microseconds=1)
    elif isinstance(value, datetime.date):
        value = (value - _EPOCH.date()).days
    if not isinstance(value, (int, float, decimal.Decimal)):
        return None
    near = float(value)
    wrong = near > value if outwards < 0 else near < value
    return math.nextafter(near, outwards) if wrong else near


def groups_in(stats: DataFrame, ranges: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Every row group with ``is_read``: false if the bounds of a column rule out all its rows.

    A range is closed, and open to a side that is None. Bounds that are not known rule out nothing.
    """
    outside = [F.lit(False)]
    for name, (low, high) in ranges.items():
        column = F.col("column_name") == name
        if low is not None:
            outside.append(column & (F.col("high") < F.lit(float(low))))
        if high is not None:
            outside.append(column & (F.col("low") > F.lit(float(high))))
    missed = F.coalesce(reduce(Column.__or__, outside), F.lit(False))
    return stats.groupBy("file", "row_group", "first_row", "rows").agg((~F.max(missed)).alias("is_read"))


def skipping(stats: DataFrame, ranges: dict[str, tuple[float | None, float | None]], label: str) -> DataFrame:
    """Row groups and rows, and how many of each a reader with these ranges has to read."""
    read = F.col("is_read")
    return groups_in(stats, ranges).agg(
        F.count(F.lit(1)).alias("groups"), F.count(F.when(read, 1)).alias("groups_read"),
        F.sum("rows").alias("row_count"), F.coalesce(F.sum(F.when(read, F.col("rows"))), F.lit(0)).alias("rows_read"),
    ).select(F.lit(label).alias("layout"), "*")


def _plain(path: str) -> Column:
    """A path without its scheme, which is written with one or three slashes."""
    return F.regexp_replace(F.col(path), "^[a-z0-9]+:/*", "/")


def recomputed(df: DataFrame, groups: DataFrame, wanted: Column, columns: dict[str, Column]) -> DataFrame:
    """What the rows themselves say of each row group: rows, rows wanted, and the bounds of ``columns`` (as numbers).

    ``df`` reads the same files as ``groups`` (``groups_in``) describes.
    """
    rows = df.select(
        _plain("_metadata.file_path").alias("_name"), F.col("_metadata.row_index").alias("_row"),
        wanted.alias("_wanted"), *[c.cast("double").alias(f"_v_{n}") for n, c in columns.items()])
    placed = groups.withColumn("_name", _plain("file"))
    inside = (F.col("_row") >= F.col("first_row")) & (F.col("_row") < F.col("first_row") + F.col("rows"))
    return rows.join(placed, "_name").where(inside).groupBy("file", "row_group", "rows", "is_read").agg(
        F.count(F.lit(1)).alias("rows_found"), F.count(F.when(F.col("_wanted"), 1)).alias("rows_wanted"),
        *[f(f"_v_{n}").alias(f"{kind}_{n}") for n in columns for kind, f in (("low", F.min), ("high", F.max))])
