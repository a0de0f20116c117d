"""A stream over Parquet files whose micro-batches hold at most a given number of rows.

The built-in file source bounds a micro-batch by files or bytes; here the offset is a place inside a file, so
a large file is cut and small ones are put together. Only footers are read to plan a batch: they say how
many rows a file has. Executors read the row groups that a slice touches, in Arrow batches.

Files are taken in the order of modification time and name. The offset counts the files before its place, so
a file that turns up behind it is noticed and ends the query, rather than being left out. Files must not change or be
deleted while the stream needs them.

A micro-batch costs a fixed time, however few rows it has, so a long stream can be dealt to lanes that run side by side:
the rows in order are cut into stripes of the given number of rows, and a lane takes every so many-th stripe. The
last stripe may be short; rows that arrive for it later make a micro-batch of their own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

MAX_ROWS = 1_000


@dataclass
class Slice(InputPartition):
    """Rows ``first`` to ``end`` of one file."""

    path: str
    first: int
    end: int


class RowCappedParquet(DataSource):
    """Options: ``path`` (a folder), ``maxRowsPerBatch``, ``lane`` of ``lanes``."""

    @classmethod
    def name(cls) -> str:
        return "row_capped_parquet"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        rows, lane, lanes = (int(self.options.get(o, d)) for o, d in (("maxRowsPerBatch", MAX_ROWS), ("lane", 0), ("lanes", 1)))
        return RowCappedReader(self.options["path"], rows, schema.fieldNames(), lane, lanes)


class RowCappedReader(DataSourceStreamReader):
    def __init__(self, path: str, max_rows: int, columns: list[str], lane: int = 0, lanes: int = 1):
        if max_rows < 1:
            raise ValueError("maxRowsPerBatch must be 1 or more")
        if not 0 <= lane < lanes:
            raise ValueError("lane must be from 0 to lanes - 1")
        self.max_rows, self.columns, self.path, self.lane, self.lanes = max_rows, columns, path, lane, lanes
        self._at: dict | None = None  # the end of the last planned batch
        self._rows: dict[str, int] = {}

    # --- on the driver ---

    def initialOffset(self) -> dict:
        return {"files": 0, "mtime": 0, "file": "", "row": 0}

    def latestOffset(self) -> dict:
        """At most ``max_rows`` rows behind the last planned batch."""
        at = self._at or self.initialOffset()
        files = self._files()
        self._check(files, at)
        if self.lanes > 1:
            return self._stripe(files, at)
        left = self.max_rows
        for n in range(max(at["files"] - 1, 0), len(files)):
            mtime, path = files[n]
            first = at["row"] if n + 1 == at["files"] else 0
            taken = min(left, self._count(path) - first)
            if taken > 0:
                at, left = {"files": n + 1, "mtime": mtime, "file": path, "row": first + taken}, left - taken
            if not left:
                break
        return at

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        """The slices between two offsets; on a restart Spark plans the last batch again, which gives the place."""
        self._at = end
        files = self._files()[:end["files"]]
        if self.lanes > 1:
            return self._striped(files, start, end)
        slices = []
        for n, (_, path) in enumerate(files):
            if n + 1 < start["files"]:
                continue
            first = start["row"] if n + 1 == start["files"] else 0
            last = end["row"] if n + 1 == end["files"] else self._count(path)
            if last > first:
                slices.append(Slice(path, first, last))
        return slices

    def commit(self, end: dict) -> None:
        pass

    def _stripe(self, files: list[tuple[int, str]], at: dict) -> dict:
        """The end of the lane's first stripe that has rows behind a place."""
        before = self._before(files)
        place = self._place(before, at)
        stripe = place // self.max_rows
        stripe += (self.lane - stripe) % self.lanes
        end = min((stripe + 1) * self.max_rows, before[-1])
        if end <= max(place, stripe * self.max_rows):
            return at
        n = bisect_left(before, end)
        mtime, path = files[n - 1]
        return {"files": n, "mtime": mtime, "file": path, "row": end - before[n - 1]}

    def _striped(self, files: list[tuple[int, str]], start: dict, end: dict) -> list[Slice]:
        """The slices of the stripe that ends at ``end``; those between it and ``start`` are other lanes'."""
        before = self._before(files)
        last = self._place(before, end)
        first = max(self._place(before, start), (last - 1) // self.max_rows * self.max_rows)
        cut = [(path, max(first - rows, 0), min(last - rows, self._count(path))) for (_, path), rows in zip(files, before)]
        return [Slice(path, a, b) for path, a, b in cut if a < b]

    def _before(self, files: list[tuple[int, str]]) -> list[int]:
        """The rows before each file, and of all."""
        return list(accumulate((self._count(path) for _, path in files), initial=0))

    @staticmethod
    def _place(before: list[int], at: dict) -> int:
        """The number of rows before an offset."""
        return before[at["files"] - 1] + at["row"] if at["files"] else 0

    def _files(self) -> list[tuple[int, str]]:
        fs, folder = _open(self.path)
        found = fs.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        named = [f for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
        return sorted((f.mtime_ns or 0, f.path) for f in named)

    def _check(self, files: list[tuple[int, str]], at: dict) -> None:
        before = sum((m, p) <= (at["mtime"], at["file"]) for m, p in files)
        if before != at["files"]:
            raise ValueError(f"{self.path} has {before} files up to the one that was read last, and had {at['files']}")

    def _count(self, path: str) -> int:
        if path not in self._rows:
            fs, _ = _open(self.path)
            with fs.open_input_file(path) as file:
                self._rows[path] = pq.ParquetFile(file).metadata.num_rows
        return self._rows[path]

    # --- on executors ---

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        with fs.open_input_file(partition.path) as file:
            parquet = pq.ParquetFile(file)
            groups, start, offset = [], 0, None
            for g in range(parquet.num_row_groups):
                rows = parquet.metadata.row_group(g).num_rows
                if start < partition.end and start + rows > partition.first:
                    groups.append(g)
                    offset = start if offset is None else offset
                start += rows
            at = offset or 0
            for batch in parquet.iter_batches(row_groups=groups, columns=self.columns):
                cut = batch.slice(max(partition.first - at, 0), max(min(partition.end - at, batch.num_rows) - max(partition.first - at, 0), 0))
                at += batch.num_rows
                if cut.num_rows:
                    yield cut.select(self.columns)
                if at >= partition.end:
                    break


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path with or without a scheme, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


def parquet_rows(spark: SparkSession, path: str, schema: StructType, max_rows: int = MAX_ROWS, lane: int = 0, lanes: int = 1) -> DataFrame:
    """The stream of a folder of Parquet files, or a lane of it, in micro-batches of at most ``max_rows`` rows."""
    spark.dataSource.register(RowCappedParquet)
    options = {"maxRowsPerBatch": max_rows, "lane": lane, "lanes": lanes}
    return spark.readStream.format("row_capped_parquet").schema(schema).options(**options).load(path)
