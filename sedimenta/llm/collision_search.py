"""Approximate nearest neighbours by collision counting.

Every projection is one sorted array of the vectors' values. A query opens a window around its own value in each array;
virtual rehashing widens all windows by a factor, and only what is new is counted. A vector that
collides with the query in at least a share of the projections is verified by its exact inner product. The search
of a query ends when its k-th nearest verified vector lies within the radius the windows stand for, or when
the windows cover everything.

Largest inner products are nearest points once each vector gets one more component that lifts it to the
largest norm. Vectors form blocks with arrays of their own; each block answers each block of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.vectors import matrix, packed
from sedimenta.session import materialise

#: Vectors and queries of a block.
VECTORS, QUERIES = 8192, 1024
#: Projections, half a window in units of the radius, share of collisions, first radius and growth (of the largest norm).
PROJECTIONS, HALF_WIDTH, THRESHOLD, FIRST_RADIUS, GROWTH = 48, 0.75, 0.42, 0.2, 1.2


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query_id, id, inner product) of the nearest found of each query in one block."""
    n, d = vectors.shape
    norms = np.linalg.norm(vectors, axis=1)
    top = norms.max()
    lifted = np.column_stack([vectors / top, np.sqrt(np.maximum(0, 1 - (norms / top) ** 2))])
    lines = np.random.default_rng(5).standard_normal((d + 1, PROJECTIONS))
    values = lifted @ lines
    order = np.argsort(values, axis=0, kind="stable").T.copy()
    arrays = np.take_along_axis(values.T, order, axis=1)
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    places, need, out = unit @ lines[:d], THRESHOLD * PROJECTIONS, []
    radii = [FIRST_RADIUS]
    while radii[-1] < 2:
        radii.append(radii[-1] * GROWTH)
    reach = HALF_WIDTH * np.array([0.0, *radii, 2.0 * d + 64])  # the last windows cover everything
    lows = np.stack([np.searchsorted(a, p[:, None] - reach) for a, p in zip(arrays, places.T, strict=True)], axis=2)
    highs = np.stack([np.searchsorted(a, p[:, None] + reach, "right") for a, p in zip(arrays, places.T, strict=True)], axis=2)
    highs[:, 0], lows[:, -1], highs[:, -1] = lows[:, 0], 0, n
    radii, ended = [0.0, *radii, np.inf], 2
    for q, qid in enumerate(query_ids.tolist()):
        counts, verified = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        own, best = ids != qid, np.empty(0, dtype=np.int64)
        scores = np.empty(0)
        # The first windows are those of the turn before the last query's end: narrower ones hold nothing that these don't.
        before, turns = 0, range(max(1, ended - 1), len(radii))
        for turn in turns:
            low, high = lows[q, turn], highs[q, turn]
            inside = (high - low).sum()
            if PROJECTIONS * n - inside < inside - (highs[q, before] - lows[q, before]).sum():
                # Wide windows: those outside are fewer than the new ones inside.
                cuts = zip(order, low.tolist(), high.tolist(), strict=True)
                counts = PROJECTIONS - np.bincount(np.concatenate([piece for o, x, t in cuts for piece in (o[:x], o[t:])]), minlength=n)
            else:
                cuts = zip(order, low.tolist(), lows[q, before].tolist(), highs[q, before].tolist(), high.tolist(), strict=True)
                counts += np.bincount(np.concatenate([piece for o, x, y, z, t in cuts for piece in (o[x:y], o[z:t])]), minlength=n)
            before = ended = turn
            passed = np.flatnonzero((counts >= need) & ~verified & own)
            if len(passed):
                verified[passed] = True
                # To gather more than half of the rows costs more than to multiply them all.
                found = np.einsum('ij,j->i', vectors[passed], queries[q]) if 2 * len(passed) < n else np.einsum('ij,j->i', vectors, queries[q])[passed]
                best, scores = np.append(best, passed), np.append(scores, found)
                if len(best) > 4 * k:  # what can't be among the k best, ties included, needs no sorting
                    least = np.partition(scores, len(scores) - k)[-k]
                    best, scores = best[scores >= least], scores[scores >= least]
                keep = np.lexsort((ids[best], -scores))[:k]
                best, scores = best[keep], scores[keep]
            if len(best) == k:
                cosine = scores[-1] / (top * np.linalg.norm(queries[q]))
                if 2 - 2 * cosine <= radii[turn]**2:
                    break
        out += [(qid, i, s) for i, s in zip(ids[best].tolist(), scores.tolist(), strict=True)]
    return out


def nearest(table: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` nearest found by inner product, ties to smaller ids.

    ``is_query`` is a condition on ``id``; candidates are all rows but those with the query's own id. Vectors that are null,
    empty, zero or hold a null or a non-finite component, and null ids, take no part; vectors are compared with
    queries of their length. Of rows that repeat an id one counts, the smallest in byte order. Other columns are left out.
    """
    rows = packed(table, id_col, vector_col).where("mark is not null and id is not null")
    rows = materialise(rows.groupBy("id").agg(F.min("body").alias("body")), "vectors")
    queries = rows.where(is_query)
    shards, blocks = 1 + rows.count() // VECTORS, 1 + queries.count() // QUERIES
    spread, size = F.xxhash64("id"), F.length("body").alias("size")
    many = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = rows.select(size, F.pmod(spread, F.lit(shards)).alias("shard"), many(blocks).alias("block"), F.lit(False).alias("query"), "id", "body")
    right = queries.select(size, many(shards).alias("shard"), F.pmod(spread, F.lit(blocks)).alias("block"), F.lit(True).alias("query"), "id", "body")

    def search(cell: pa.Table) -> pa.Table:
        asks = np.asarray(cell.column("query"))
        ids, vectors = np.asarray(cell.column("id")), matrix(cell.column("body"))
        found = search_block(ids[~asks], vectors[~asks], ids[asks], vectors[asks], k) if asks.any() and not asks.all() else []
        q, i, s = zip(*found, strict=True) if found else ([], [], [])
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    found = left.union(right).groupBy("size", "shard", "block").applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
