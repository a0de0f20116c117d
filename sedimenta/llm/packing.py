"""Conflict-constrained best-fit packing.

Documents are cut into chunks of at most one bin's capacity. Chunks meet in pools of bounded size; a pool places its
chunks from the largest to the smallest. Its bins stand in the order of what they have left and
carry a bitmap of sources and one of duplicate clusters. From the first bin that is large enough the search
goes on, bin by bin, until one has neither the chunk's source nor its cluster: the tightest compatible
bin. Without one, a new bin opens.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import materialise

#: Chunks a pool holds on average.
POOL_CHUNKS = 1024


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each chunk, placed in the order given. Equal numbers mean a conflict; -1 has none."""
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s = 1 << source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (source_bits[order[at][1]] & s or cluster_bits[order[at][1]] & c):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
        else:
            residual, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= s
        cluster_bits[b] |= c
        insort(order, (residual - size, b))
        bins.append(b)
        offsets.append(capacity - residual)
    return bins, offsets


def _numbers(column: pa.ChunkedArray) -> list[int]:
    """Small numbers for equal values, -1 for null."""
    seen: dict = {}
    return [-1 if v is None else seen.setdefault(v, len(seen)) for v in column.to_pylist()]


def pack(items: DataFrame, *, capacity: int, id_col: str = "doc_id", size_col: str = "n_words", source_col: str = "source",
         cluster_col: str = "cluster", pool_chunks: int = POOL_CHUNKS) -> DataFrame:
    """One row per chunk: doc_id, chunk, n_chunks, first, size, pool, bin, bin_offset.

    Every row of ``items`` is packed, repeated ones and null ids too. ``first`` and ``size`` say which units of the
    document a chunk has. A bin (pool, bin) holds ``capacity`` units at most, no source and no cluster twice; a null
    source or cluster conflicts with nothing. A null or negative size counts as 0: its empty
    chunk takes a place in a bin like any other. Ties go by id, then chunk. An empty table gives an empty result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    size = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    rows = items.select(F.col(id_col).alias("doc_id"), size.alias("n"), F.col(source_col).alias("source"), F.col(cluster_col).alias("cluster"))
    rows = rows.withColumn("n_chunks", F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)).cast("bigint"))
    rows = materialise(rows, "items")
    pools = 1 + (rows.agg(F.sum("n_chunks")).first()[0] or 0) // pool_chunks
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_chunks") - 1)))
    rows = rows.withColumns({"first": F.col("chunk") * capacity, "size": F.least(F.lit(capacity).cast("bigint"), F.col("n") - F.col("chunk") * capacity)})
    # Chunks of a document or copies of one spread over the pools, so no pool holds a large group.
    rows = rows.withColumn("pool", F.pmod(F.xxhash64("doc_id", "cluster", "chunk", "n"), F.lit(pools)))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("chunk", "ascending")])
        bins, offsets = best_fit(table.column("size").to_pylist(), _numbers(table.column("source")), _numbers(table.column("cluster")), capacity)
        out = table.select(["doc_id", "chunk", "n_chunks", "first", "size", "pool"])
        return out.append_column("bin", pa.array(bins, pa.int64())).append_column("bin_offset", pa.array(offsets, pa.int64()))

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, chunk bigint, n_chunks bigint, first bigint, size bigint, pool bigint, bin bigint, bin_offset bigint"
    return rows.groupBy("pool").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """Pack documents by words. A cluster is the words of a text in lower case: copies share one."""
    words = F.split(F.trim(F.regexp_replace(F.lower("text"), r"[\x20\x09-\x0D]+", " ")), " ")
    shaped = docs.select("doc_id", "source", words.alias("words"))
    n = F.when(F.col("words").isNull() | (F.col("words") == F.array(F.lit(""))), 0).otherwise(F.size("words"))
    cluster = F.when(n > 0, F.md5(F.concat_ws(" ", "words")))
    return pack(shaped.select("doc_id", "source", n.alias("n_words"), cluster.alias("cluster")), capacity=capacity)
