"""Trie of conversation prefixes, by union-find over sorted neighbours.

Conversations are sorted by their turns, so the members of every trie node are consecutive rows, and
two neighbours share as many turns as their longest common prefix (LCP). Every pair of neighbours is
an edge. Taken in descending order of LCP, an edge at depth d unites two components: that makes a
branching node at depth d, above the top nodes of both. The turns between a node and its parent are a
chain of nodes with the same members.

Spark sorts the rows by range; a task reads its range in blocks of bounded size and builds the forest of
each block. Nodes that hold neither the first nor the last row of their block are complete. The others
(the two edges of the forest, as many nodes as two conversations have turns) may go on in the next
block. They are the contracted forest: equal depths of neighbouring blocks are one node wherever the
LCP across the boundary reaches that depth. Every count of a node is a sum over blocks in which what
lies across a boundary is counted on one side only, so copies of one conversation may fill any number
of blocks.

Turns count as equal when role and text are (128 bits of SHA-256). Null roles and texts are empty.
Turns ascend, null first; of equal turns the role and then the digest decides, and rows that repeat stay
turns of their own. Rows without a conversation id take no part. A conversation is one row of 20 bytes
a turn here, however long its texts are. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import materialise

#: Bytes of a turn in the sort key.
TURN_BYTES = 16
#: Conversations and turns of a block; both only bound the memory of a task.
BLOCK_ROWS = 50_000
BLOCK_TURNS = 1_000_000
#: Ids in one piece of the list of conversations that end at a node.
PIECE_IDS = 50_000
#: Leading turns that `rebuilt` may take from another conversation.
MOST_SHARED = 8

#: Fixed value: SHA-256 of the empty text.
NO_ENDS = hashlib.sha256(b"").hexdigest()

_COLUMNS = {
    "kind": pa.string(), "task": pa.int32(), "block": pa.int32(), "depth": pa.int64(), "conv_id": pa.int64(),
    "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "member_bytes": pa.int64(),
    "tree_bytes": pa.int64(), "own_bytes": pa.int64(), "ends": pa.string(), "on_left": pa.bool_(), "on_right": pa.bool_(),
    "parent_id": pa.int64(), "parent_left": pa.bool_(), "shared": pa.int64(), "first_key": pa.binary(), "last_key": pa.binary(),
    "last_length": pa.int64()}
_SCHEMA = pa.schema(list(_COLUMNS.items()))
_DDL = (
    "kind string, task int, block int, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "member_bytes bigint, tree_bytes bigint, own_bytes bigint, ends string, on_left boolean, on_right boolean, "
    "parent_id bigint, parent_left boolean, shared bigint, first_key binary, last_key binary, last_length bigint")


# --- sequences -----------------------------------------------------------------------------


def sequences(rows: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns``, an array of (turn digest in hex, UTF-8 bytes of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    code = F.substring(F.sha2(marked, 256), 1, 2 * TURN_BYTES)
    # Nulls come first in a sorted array of structs.
    entry = F.struct(
        F.col("turn").cast("bigint").alias("turn"), role.alias("role"), code.alias("code"), F.octet_length(text).alias("n"))
    listed = rows.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(entry)).alias("all"))
    return listed.select("conv_id", F.transform("all", lambda t: F.struct(t["code"].alias("code"), t["n"].alias("n"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Replace the first h turns of conversation c by those of conversation c - c % 5, h = crc32(c) % 9."""
    convs = materialise(convs, "trie-conversations")
    of, h = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    heads = convs.where(F.col("conv_id") % 5 == 0).select(
        F.col("conv_id").alias("_of"), F.slice("turns", 1, MOST_SHARED).alias("_head"))
    joined = convs.withColumns({"_of": of, "_h": h.cast("int")}).join(heads, "_of", "left")
    none = F.array().cast(convs.schema["turns"].dataType)
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), none)
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


# --- the forest of a block -----------------------------------------------------------------


def shared_turns(digests: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """LCP in turns of every row with the next one; ``digests`` holds all turns, two words each."""
    least = np.minimum(lengths[:-1], lengths[1:])
    begin = np.cumsum(least) - least
    within = np.arange(int(least.sum())) - np.repeat(begin, least)
    a, b = np.repeat(starts[:-1], least) + within, np.repeat(starts[1:], least) + within
    differ = np.append(np.flatnonzero((digests[a] != digests[b]).any(axis=1)), len(a))
    first = differ[np.searchsorted(differ, begin)]
    return np.minimum(first - begin, least)


class Forest:
    """Nodes over sorted rows, made by uniting components in descending order of depth.

    Node i < n is the end of row i until it is united with a node of its own depth. ``parent`` is -1 at the top.
    ``below`` sums the bytes of all nodes under a node; ``ends`` counts the rows that end at it.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, shared: np.ndarray, prefix_bytes) -> None:
        n = len(ids)
        self.depth, self.low, self.high = lengths.tolist(), list(range(n)), list(range(n))
        self.least, self.ends = ids.tolist(), [1] * n
        self.children, self.leaves, self.below = [0] * n, [0] * n, [0] * n
        self.parent, self.alive = [-1] * n, [True] * n
        self._bytes = prefix_bytes  # (row, depth) -> bytes of its first turns
        up, top = list(range(n)), list(range(n))  # union-find over rows; the top node of each component

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for i in np.argsort(-shared, kind="stable").tolist():
            a, b = find(i), find(i + 1)
            united = self._unite(top[a], top[b], int(shared[i]))
            up[b] = a
            top[a] = united
        self.top = top[find(0)]
        if self.depth[self.top]:
            root = self._node(0, self.top)
            self._attach(self.top, root)
            self.top = root
        if not self.children[self.top]:
            self.leaves[self.top] = 1

    def _node(self, depth: int, like: int) -> int:
        for column, value in (
                (self.depth, depth), (self.low, self.low[like]), (self.high, self.high[like]), (self.least, self.least[like]),
                (self.ends, 0), (self.children, 0), (self.leaves, 0), (self.below, 0), (self.parent, -1), (self.alive, True)):
            column.append(value)
        return len(self.depth) - 1

    def _unite(self, a: int, b: int, depth: int) -> int:
        """The node at ``depth`` above the neighbouring components with the top nodes a and b."""
        if self.depth[a] == depth:
            node = a
        elif self.depth[b] == depth:
            node, b = b, a
        else:
            node = self._node(depth, a)
            self._attach(a, node)
        if self.depth[b] == depth:  # the same node, found on both sides
            for column in (self.ends, self.children, self.leaves, self.below):
                column[node] += column[b]
            self.alive[b] = False
            self._widen(node, b)
        else:
            self._attach(b, node)
        return node

    def _widen(self, node: int, by: int) -> None:
        self.low[node] = min(self.low[node], self.low[by])
        self.high[node] = max(self.high[node], self.high[by])
        self.least[node] = min(self.least[node], self.least[by])

    def _attach(self, child: int, node: int) -> None:
        if not self.children[child]:
            self.leaves[child] = 1
        self.parent[child] = node
        self.children[node] += 1
        self.leaves[node] += self.leaves[child]
        row = self.low[child]
        self.below[node] += self.below[child] + self._bytes(row, self.depth[child]) - self._bytes(row, self.depth[node])
        self._widen(node, child)


def _block_rows(task: int, block: int, rows: list[tuple], before: bytes | None) -> pa.Table:
    """All rows of one block: its nodes, the pieces of open lists of ends, and the block itself.

    Complete nodes are of kind ``node``, those that hold the block's first or last row of kind ``edge``.
    """
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    lengths = np.array([len(r[1]) // TURN_BYTES for r in rows], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    digests = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint64).reshape(-1, 2)
    sizes = np.concatenate([r[2] for r in rows]) if lengths.sum() else np.empty(0, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])  # bytes of all turns before each
    row_bytes = np.concatenate([[0], np.cumsum(total[starts + lengths] - total[starts])])
    listed = total.tolist()
    first = starts.tolist()
    forest = Forest(ids, lengths, shared_turns(digests, starts, lengths), lambda row, d: listed[first[row] + d] - listed[first[row]])

    live = np.flatnonzero(forest.alive)
    take = lambda column: np.array(column, dtype=np.int64)[live]
    low, high, depth, parent = take(forest.low), take(forest.high), take(forest.depth), take(forest.parent)
    all_depth, all_low = np.array(forest.depth, dtype=np.int64), np.array(forest.low, dtype=np.int64)
    all_high = np.array(forest.high, dtype=np.int64)
    above = np.where(parent >= 0, all_depth[parent], -1)
    reach = depth - above  # nodes of the chain from below the parent down to the node
    chain = np.repeat(np.arange(len(live)), reach)
    at = np.arange(int(reach.sum())) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(above + 1, reach)
    bottom, head = at == depth[chain], at == above[chain] + 1
    row, count = low[chain], (high - low + 1)[chain]
    upto = lambda d: total[starts[row] + np.maximum(d, 0)] - total[starts[row]]
    last = len(rows) - 1
    on_left, on_right = row == 0, high[chain] == last
    edge = on_left | on_right
    owner = np.where(head, parent[chain], live[chain])  # the node whose chain holds the parent
    parent_left = np.where(owner >= 0, all_low[owner] == 0, False)
    parent_open = np.where(owner >= 0, parent_left | (all_high[owner] == last), False)
    least = np.array(forest.least, dtype=np.int64)
    ends = np.where(bottom, take(forest.ends)[chain], 0)
    lists: list[str | None] = [NO_ENDS] * len(at)
    pieces = []
    for i in np.flatnonzero(ends).tolist():
        mine = ids[row[i]:row[i] + ends[i]].tolist()
        if edge[i]:
            lists[i] = None
            pieces += [(int(at[i]), bool(on_left[i]), j, ",".join(map(str, mine[j:j + PIECE_IDS]))) for j in range(0, len(mine), PIECE_IDS)]
        else:
            lists[i] = hashlib.sha256(",".join(map(str, mine)).encode()).hexdigest()
    nodes = {
        "kind": np.where(edge, "edge", "node"), "depth": at, "conv_id": least[live][chain], "n_convs": count,
        "n_children": np.where(bottom, take(forest.children)[chain], 1), "n_leaves": take(forest.leaves)[chain],
        "member_bytes": (row_bytes[high + 1] - row_bytes[low])[chain] - count * upto(at - 1),
        "tree_bytes": take(forest.below)[chain] + upto(depth[chain]) - upto(at - 1), "own_bytes": upto(at) - upto(at - 1),
        "ends": pa.array(lists, pa.string()), "on_left": on_left, "on_right": on_right,
        "parent_id": pa.array(np.where(owner >= 0, least[owner], 0), mask=parent_open | (owner < 0)),
        "parent_left": pa.array(parent_left, mask=~parent_open)}
    own = {
        "kind": ["block"], "shared": [None if before is None else _common(before, rows[0][1])],
        "first_key": [rows[0][1] if before is None else None], "last_key": [rows[-1][1]], "last_length": [int(lengths[-1])]}
    lists_open = {
        "kind": ["ends"] * len(pieces), "depth": [p[0] for p in pieces], "on_left": [p[1] for p in pieces],
        "shared": [p[2] for p in pieces], "ends": [p[3] for p in pieces]}
    return pa.concat_tables([_filled(part, task, block) for part in (nodes, lists_open, own)])


def _filled(columns: dict, task: int, block: int) -> pa.Table:
    n = len(columns["kind"])
    columns = columns | {"task": np.full(n, task), "block": np.full(n, block)}
    return pa.table([
        pa.array(columns[c], t) if c in columns and not isinstance(columns[c], pa.Array)
        else columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in _COLUMNS.items()], schema=_SCHEMA)


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys share."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a[:n], dtype=np.uint8) != np.frombuffer(b[:n], dtype=np.uint8))
    return (int(differ[0]) if len(differ) else n) // TURN_BYTES


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of one task, which reads its rows in order."""
    task = pyspark.TaskContext.get().partitionId()
    held: list[tuple] = []
    block = turns = 0
    before = None
    for batch in batches:
        sizes = batch.column("sizes")
        flat = np.asarray(sizes.flatten()).astype(np.int64)
        cuts = np.cumsum(np.asarray(sizes.value_lengths()))[:-1] if batch.num_rows else []
        columns = (batch.column("conv_id").to_pylist(), batch.column("key").to_pylist(), np.split(flat, cuts))
        for row in zip(*columns, strict=True) if batch.num_rows else ():
            held.append(row)
            turns += len(row[2])
            if len(held) >= BLOCK_ROWS or turns >= BLOCK_TURNS:
                yield from _block_rows(task, block, held, before).to_batches()
                before, held, block, turns = held[-1][1], [], block + 1, 0
    if held:
        yield from _block_rows(task, block, held, before).to_batches()


# --- across blocks -------------------------------------------------------------------------


def trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie over ``convs`` (conv_id, turns)."""
    code = F.unhex(F.array_join(F.transform("turns", lambda t: t["code"]), ""))
    keyed = convs.select("conv_id", code.alias("key"), F.transform("turns", lambda t: t["n"].cast("bigint")).alias("sizes"))
    dealt = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    grown = materialise(dealt.mapInArrow(_forests, _DDL), "trie-forests")
    merged = materialise(_merged(grown), "trie-edges")
    of_edge = merged.select(
        "task", "block", "depth", "on_left", F.col("conv_id").alias("found_id"))
    saved = F.col("member_bytes") - F.col("tree_bytes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    inner = grown.where("kind = 'node'").withColumns({"saved_tokens": saved, "ends_sha256": F.col("ends")})
    closed = inner.where(F.col("parent_left").isNull()).withColumn("parent_conv_id", F.col("parent_id"))
    parent = ["task", "block", "depth", "on_left"]
    hanging = inner.where(F.col("parent_left").isNotNull()).withColumns({"at": F.col("depth"), "depth": F.col("depth") - 1})
    hung = hanging.withColumn("on_left", F.col("parent_left")).join(of_edge, parent).withColumns(
        {"depth": F.col("at"), "parent_conv_id": F.col("found_id")})

    tops = merged.where("is_first").withColumns({"at": F.col("depth"), "depth": F.col("depth") - 1})
    outer = tops.withColumn("on_left", F.col("parent_left")).join(of_edge, parent, "left").withColumns(
        {"depth": F.col("at"), "parent_conv_id": F.coalesce("found_id", "parent_id"), "saved_tokens": saved})
    joined = outer.join(_ends(grown, merged), ["at", "run"], "left").withColumn("ends_sha256", F.coalesce("hash", F.lit(NO_ENDS)))
    return closed.select(*columns).unionByName(hung.select(*columns)).unionByName(joined.select(*columns))


def _boundaries(grown: DataFrame) -> DataFrame:
    """Per block the turns it shares with the block before and after it (null: there is none)."""
    blocks = grown.where("kind = 'block'")
    # As many rows as the sort had tasks, and no keys: only the numbers of the tasks are put in order.
    tasks = blocks.groupBy("task").agg(F.max("block").alias("last"))
    chain = tasks.select("task", *[F.lag(c).over(Window.orderBy("task")).alias(f"_{c}") for c in ("task", "last")])
    ends = blocks.select(F.col("task").alias("_task"), F.col("block").alias("_last"), F.col("last_key").alias("_key"))
    firsts = blocks.where("block = 0").select("task", "first_key").join(chain, "task").join(ends, ["_task", "_last"])
    crossing = firsts.mapInArrow(_common_keys, "task int, _crossing bigint")
    shared = blocks.select("task", "block", "shared", "last_length").join(
        crossing.withColumn("block", F.lit(0)), ["task", "block"], "left")
    left = shared.select("task", "block", "last_length", F.coalesce("shared", "_crossing").alias("left"))
    within = Window.partitionBy("task").orderBy("block")
    nexts = chain.where(F.col("_task").isNotNull()).join(left.where("block = 0"), "task").select(
        F.col("_task").alias("task"), F.col("left").alias("_after"))
    right = F.coalesce(F.lead("left").over(within), "_after")
    return left.join(nexts, "task", "left").select("task", "block", "left", right.alias("right"), "last_length")


def _common_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("_key").to_pylist(), batch.column("first_key").to_pylist(), strict=True)
        shared = pa.array([_common(a, b) for a, b in pairs], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("task").cast(pa.int32()), shared], ["task", "_crossing"])


def _merged(grown: DataFrame) -> DataFrame:
    """Every edge node with the figures of the whole node that it is a part of.

    ``run`` numbers the nodes of a depth along the blocks; ``is_first`` marks one row of each.
    """
    edges = grown.where("kind = 'edge'").drop("last_length").join(_boundaries(grown), ["task", "block"])
    left, right = F.coalesce("left", F.lit(-1)), F.coalesce("right", F.lit(-1))
    # Counted in the block where a node ends: its bytes, and whether it is a leaf.
    here = F.when(F.col("on_right") & (F.col("depth") <= right), F.col("own_bytes")).otherwise(0)
    down = Window.partitionBy("task", "block", "on_right").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    goes_on = F.col("on_right") & (right >= F.col("last_length"))
    # Counted in the block where it begins: whether it is a child.
    begun = F.col("on_left") & (left > F.col("depth"))
    counted = edges.select(
        "task", "block", "depth", "conv_id", "n_convs", "member_bytes", "on_left", "parent_left", "parent_id",
        (F.col("n_children") - begun.cast("int")).alias("n_children"), (F.col("n_leaves") - goes_on.cast("int")).alias("n_leaves"),
        (F.col("tree_bytes") - F.sum(here).over(down)).alias("tree_bytes"),
        (F.col("on_left") & (F.col("depth") <= left)).alias("continues"))
    along = Window.partitionBy("depth").orderBy("task", "block", F.desc("on_left"))
    run = F.sum((~F.col("continues")).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    numbered = counted.withColumn("run", run)
    whole = Window.partitionBy("depth", "run")
    order = whole.orderBy("task", "block", F.desc("on_left"))
    sums = {c: F.sum(c).over(whole) for c in ("n_convs", "member_bytes", "n_children", "n_leaves", "tree_bytes")}
    return numbered.withColumns(
        {"is_first": F.row_number().over(order) == 1, "conv_id": F.min("conv_id").over(whole)} | sums).drop("continues")


def _ends(grown: DataFrame, merged: DataFrame) -> DataFrame:
    """The digests of the lists of ids that end at edge nodes: a list streams through one task, piece by piece."""
    pieces = grown.where("kind = 'ends'").select("task", "block", "depth", "on_left", F.col("shared").alias("piece"), "ends")
    runs = merged.select("task", "block", "depth", "on_left", "run")
    placed = pieces.join(runs, ["task", "block", "depth", "on_left"])
    ordered = placed.repartition("depth", "run").sortWithinPartitions("depth", "run", "task", "block", F.desc("on_left"), "piece")
    return ordered.select("depth", "run", "ends").mapInArrow(_hash_lists, "at bigint, run bigint, hash string")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, out = None, None, []
    names = ["at", "run", "hash"]

    def table() -> pa.RecordBatch:
        rows = [*zip(*out, strict=True)] or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.int64(), pa.int64(), pa.string()), strict=True)], names)

    for batch in batches:
        for depth, run, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, run) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, run), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield table()
    if key is not None:
        out.append((*key, state.hexdigest()))
        yield table()


def rebuilt_trie(rows: DataFrame) -> DataFrame:
    """The trie over the rebuilt conversations of ``rows`` (conv_id, turn, role, text)."""
    return trie(rebuilt(sequences(rows)))
