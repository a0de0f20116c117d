"""Near-duplicate vectors by an exact metric range join.

On the unit sphere a cosine of c is a distance of sqrt(2 - 2c). Sampled pivots cut the sphere into cells, each vector's
home being that of its nearest pivot. By the triangle inequality a vector can only have a partner at home
in another cell if it lies within that distance of the plane between the two pivots; there it is a guest. Every
vector then meets all its partners in its home cell, and cells join independently, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.graph import Forest, components
from sedimenta.llm.vectors import matrix, packed
from sedimenta.session import materialise

#: Vectors per cell aimed at, most pivots (their table goes to every task), and vectors of one side of a block.
CELL, MOST_PIVOTS, BLOCK = 8192, 4096, 8192
_SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Very large and very small ones are scaled by a power of two first, as their squares have no double."""
    largest = np.abs(x).max(axis=1, keepdims=True, initial=0.0)
    far = (largest > 1e100) | (largest < 1e-100)
    x = np.where(far, np.ldexp(x, -np.frexp(largest)[1]), x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(classes: DataFrame, n: int) -> np.ndarray:
    wanted = min(MOST_PIVOTS, 1 + n // CELL)
    rows = classes.orderBy(F.xxhash64("mark"), "mark").limit(wanted).select("body").collect()
    return np.unique(_unit(np.array([np.frombuffer(bytes(r.body)) for r in rows])), axis=0)


def near_vectors(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest id reachable) and kept (the component's own id).

    Links are pairs of rows with a cosine of at least ``cosine`` in double precision. Vectors that are null, empty, zero or hold
    a null or a non-finite component link with nothing, nor does a row with a null id; vectors of different
    lengths don't link. Equal vectors are one class with its rows counted. Other columns are left out.
    """
    rows = materialise(packed(table, id_col, vector_col), "vectors")
    valid = rows.where("mark is not null and id is not null")
    classes = materialise(valid.groupBy("mark").agg(F.min("id").alias("rep"), F.count("*").alias("w"), F.min("body").alias("body")), "classes")
    links, edges = None, None
    for size in sorted(r[0] for r in classes.select(F.length("body")).distinct().collect()):
        counted, joined = _join_cells(classes.where(F.length("body") == size), cosine)
        links, edges = (counted, joined) if links is None else (links.union(counted), edges.union(joined))
    if links is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = links.groupBy("rep").agg(F.sum("n").alias("n"))
    labels = components(edges).withColumnRenamed("id", "rep")
    classes = classes.select("mark", "rep", "w").join(links, "rep", "left").join(labels, "rep", "left")
    classes = materialise(classes.select(F.col("mark").alias("own"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")), "classes")
    found = valid.select("id", "mark").join(classes, F.col("mark") == F.col("own")).select("id", "n_links", "component")
    alone = rows.where("mark is null or id is null").select("id", F.lit(0).cast("bigint"), "id")
    return found.union(alone).select(F.col("id").alias("vec_id"), F.col("n_links").cast("bigint"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def _join_cells(classes: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(rep, n): links of each class by weight, in parts; (a, b): forests of the links of blocks."""
    pivots = _pivots(classes, classes.count())
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + _SLACK
    apart = np.linalg.norm(pivots[:, None, :] - pivots[None, :, :], axis=2) if len(pivots) <= 512 else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            square = 2 - 2 * (_unit(matrix(batch.column("body"))) @ pivots.T)
            home = square.argmin(axis=1)
            own = square[np.arange(len(home)), home]
            gap = apart[home] if apart is not None else np.linalg.norm(pivots[home][:, None, :] - pivots[None, :, :], axis=2)
            inside = square - own[:, None] <= 2 * gap * reach + _SLACK
            inside[np.arange(len(home)), home] = True
            row, cell = np.nonzero(inside)
            picked = batch.select(["rep", "w", "body"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(home[row] == cell), *picked.columns], names=["cell", "home", "rep", "w", "body"])

    members = materialise(classes.select("rep", "w", "body").mapInArrow(assign, "cell bigint, home boolean, rep bigint, w bigint, body binary"), "cells")
    sizes = members.groupBy("cell").agg(F.sum(F.col("home").cast("bigint")).alias("homes"), F.count("*").alias("all"))
    blocks = sizes.select("cell", F.ceil(F.col("homes") / BLOCK).alias("homes"), F.ceil(F.col("all") / BLOCK).alias("all")).where("homes > 0")
    placed = members.join(F.broadcast(blocks), "cell")  # MOST_PIVOTS rows at most
    spread = F.xxhash64("rep")
    left = placed.where("home").select("cell", F.pmod(spread, "homes").alias("i"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("all") - 1)).alias("j"), F.lit(True).alias("left"), "rep", "w", "body")
    right = placed.select("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("homes") - 1)).alias("i"), F.pmod(spread, "all").alias("j"), F.lit(False).alias("left"), "rep", "w", "body")

    def join(block: pa.Table) -> pa.Table:
        side = np.asarray(block.column("left"))
        rep, w, unit = np.asarray(block.column("rep")), np.asarray(block.column("w")), _unit(matrix(block.column("body")))
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        forest, counts = Forest(), np.zeros(len(a), dtype=np.int64)
        for at in range(0, len(a), 512):
            x, y = np.nonzero(unit[a[at:at + 512]] @ unit[b].T >= cosine)
            x = x + at
            other = rep[a[x]] != rep[b[y]]
            x, y = x[other], y[other]
            np.add.at(counts, x, w[b[y]])
            for p, q in zip(rep[a[x]].tolist(), rep[b[y]].tolist(), strict=True):
                forest.join(p, q)
        stars = np.array(forest.stars(), dtype=np.int64).reshape(-1, 2)
        hit = np.flatnonzero(counts)
        return pa.table({"a": np.concatenate([rep[a[hit]], stars[:, 0]]), "b": pa.array([None] * len(hit) + stars[:, 1].tolist(), pa.int64()),
                         "n": np.concatenate([counts[hit], np.zeros(len(stars), np.int64)])})

    done = materialise(left.union(right).groupBy("cell", "i", "j").applyInArrow(join, "a bigint, b bigint, n bigint"), "links")
    return done.where("b is null").select(F.col("a").alias("rep"), "n"), done.where("b is not null").select("a", "b")
