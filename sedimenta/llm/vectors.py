"""Vectors as the vector operators take them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of doubles from binary cells of equal length."""
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), dtype=np.float64).reshape(len(cells), -1) if cells else np.empty((0, 1))


def packed(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, mark, body) per row: the vector's doubles as bytes and their digest.

    Both are null for a vector that is null, empty, zero, or holds a null or a non-finite component.
    """
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for v in batch.column("v").to_pylist():
                x = np.array(v, dtype=np.float64) if v and None not in v else np.zeros(1)
                bodies.append((x + 0.0).tobytes() if np.isfinite(x).all() and x.any() else None)
            marks = [b and hashlib.md5(b).digest() for b in bodies]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(marks, pa.binary()), pa.array(bodies, pa.binary())], names=["id", "mark", "body"])

    return rows.mapInArrow(run, "id bigint, mark binary, body binary")
