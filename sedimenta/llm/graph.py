"""Connected components of links that never leave the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import materialise


class Forest:
    """Union-find over the ids a task sees; the root of a tree is its smallest id."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent, top = self.parent, x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def stars(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.parent) if (r := self.root(x)) != x]


#: Links a task gathers before it hands on their forest; bounds its memory.
_TASK_LINKS = 1_000_000


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a partition's links: every node points to its tree's smallest id."""
    forest, n = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        n += batch.num_rows
        if n >= _TASK_LINKS:
            yield _star_batch(forest)
            forest, n = Forest(), 0
    yield _star_batch(forest)


def _star_batch(forest: Forest) -> pa.RecordBatch:
    pairs = np.array(forest.stars(), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id it can reach.

    Partitions first shrink their links to forests. Then large-star and small-star steps (each node's
    neighbours move to the smallest of them) alternate until nothing changes; hubs are aggregated
    before the shuffle, and joins on them are split by AQE. Each state is written to the shared folder.
    """
    edges = links.select("a", "b").where("a <> b").mapInArrow(_thin, "a bigint, b bigint")
    state = materialise(edges.distinct(), "links")
    while not _settled(state):
        both = state.union(state.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select("u", "m")).where("a <> b")
        state = materialise(small.distinct(), "links")
    return state.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        state.select("b", "b").distinct())


def _settled(state: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has a parent."""
    ends = state.select(F.col("a").alias("x"), F.lit(1).alias("child")).union(state.select("b", F.lit(0)))
    seen = ends.groupBy("x").agg(F.sum("child").alias("up"), F.min("child").alias("low"))
    return seen.where("up > 1 or (up = 1 and low = 0)").isEmpty()
