"""Similarity links between sets that share a key, without pairs that leave the task they meet in.

Rows of groups (a key and the ids that hold it) are dealt to cells: groups with the same least id share
one, so that a set of near copies which meets under many keys meets in one place; a group of more than BLOCK rows is
cut into blocks, and every two of its blocks are a cell.

Two passes over the cells follow. In the first, members carry a bit sketch, and a task tells which of them may have a
linked partner: the first of each group is compared with all others, then whoever has no partner yet with everybody. In the second
only those members are left and carry their sets. A task joins each with the first of its group where they are linked,
then compares members that are in different trees still. What leaves it is a forest; no link between components is lost,
no pair is written, and a set of near copies costs as many comparisons as it has members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.graph import components
from sedimenta.llm.memory import give_back
from sedimenta.session import discard, materialise

#: Rows of a group that meet in one cell, and bytes they carry; rows of a cell beyond which its keys are dealt out.
BLOCK, BLOCK_BYTES, CELL_ROWS = 1_024, 4_000_000, 16_384
#: Bytes a task is to read, and of a row without what it carries.
TASK_BYTES, _ROW_BYTES = 8_000_000, 40
#: Pairs whose sizes are compared together, bytes of sketches, and items of sets.
PAIRS, SKETCH_BYTES, ITEMS = 200_000, 8_000_000, 1_000_000

#: The sorted distinct items of all members, 48 bits each, and the n + 1 places where each one's begin.
Sets = tuple[np.ndarray, np.ndarray]


def dealt(members: DataFrame, carried: int, scratch: list[DataFrame]) -> DataFrame:
    """``members`` (key, id, w) as rows (task, key, id, block, low, high); w is what an id carries, ``carried`` all of them, in bytes.

    Of keys that exactly the same ids hold one is enough. Tables that are of no use later are noted in ``scratch``.
    """
    held = members.groupBy("key").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("m"), F.sum("w").alias("w"), F.bit_xor(F.xxhash64("id")).alias("_who"))
    one = held.groupBy("first", "m", "_who").agg(F.min("key").alias("key"), F.max("w").alias("w")).drop("_who")
    one = materialise(one, "groups")
    scratch.append(one)
    total = one.agg(F.sum("m")).first()[0] or 0
    per_first = one.groupBy("first").agg(F.sum("m").alias("_all"))
    shares = F.greatest(F.lit(1), F.ceil(F.col("_all") / CELL_ROWS)).cast("bigint")
    one = one.join(per_first, "first").withColumn("share", F.pmod(F.xxhash64("key"), shares)).drop("_all")
    rows = members.drop("w").join(one, "key")
    fill = F.least(F.greatest(F.lit(1.0), F.col("m") / BLOCK, F.col("w") / BLOCK_BYTES), F.col("m"))
    rows = rows.withColumn("blocks", F.pow(2, F.ceil(F.log2(fill))).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    # Most members are carried to a few tasks.
    tasks = 1 + (total * _ROW_BYTES + 3 * carried) // TASK_BYTES
    cell = F.xxhash64("first", "share", "blocks", "low", "high")
    rows = rows.select(F.pmod(cell, F.lit(tasks)).cast("int").alias("task"), "key", "id", "block", "low", "high")
    rows = materialise(rows, "cells")
    scratch.append(rows)
    return rows


class Rows:
    """The rows of one task in order, each with the range of rows it is to be paired with."""

    def __init__(self, table: pa.Table):
        key, block, low, high, ids = (np.asarray(table.column(c)) for c in ("key", "block", "low", "high", "id"))
        order = np.lexsort((ids, block, high, low, key))
        key, block, low, high = (a[order] for a in (key, block, low, high))
        self.order, self.ids = order, ids[order]
        n = len(order)
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        self.starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(self.starts, n))
        self.start, self.end = np.repeat(self.starts, sizes), np.repeat(self.starts + sizes, sizes)
        # In a cell of two blocks, which sort one after the other, rows of the first are paired with the second.
        second = np.concatenate([[0], np.cumsum((block == high) & (low != high))])
        middle = self.end - (second[self.end] - second[self.start])
        at = np.arange(n)
        self.first = np.where(low == high, at + 1, middle)
        self.count = np.where((low == high) | (block == low), self.end - self.first, 0)

    def leaders(self) -> tuple[np.ndarray, np.ndarray]:
        """Every row with the first row of its group."""
        at = np.arange(len(self.order))
        other = at != self.start
        return self.start[other], at[other]

    def pairs(self, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of rows of a group whose labels differ, in portions."""
        if not len(self.order):
            return
        low, high = (f.reduceat(labels, self.starts) for f in (np.minimum, np.maximum))
        mixed = np.repeat(low != high, np.diff(np.append(self.starts, len(labels))))
        rows = np.flatnonzero(mixed & (self.count > 0))
        portion = np.cumsum(self.count[rows]) // PAIRS
        for part in np.split(rows, np.flatnonzero(np.diff(portion)) + 1):
            if len(part):
                count = self.count[part]
                i = np.repeat(part, count)
                j = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[part], count)
                apart = labels[i] != labels[j]
                yield i[apart], j[apart]


class Trees:
    """Union-find over the members 0 to n - 1 of a task; the root of a tree is its least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def roots(self) -> np.ndarray:
        up = np.array(self.up, dtype=np.int64)
        while (up[up] != up).any():
            up = up[up]
        return up


def parity_sketch(items: np.ndarray) -> bytes:
    """A bit sketch of a set: every item toggles one bit of 2 to 4 bits an item (64 at least).

    Items that two sets share cancel out, so the Hamming distance of two sketches is at most their symmetric
    difference. Its size is a power of two; a larger sketch folds to a smaller one.
    """
    bits = max(64, 1 << (2 * len(items)).bit_length())
    flips = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def parity_sketches(sets: Sets) -> list[bytes]:
    """The sketches of many sets."""
    items, begin = sets
    sizes = np.diff(begin)
    bits = np.maximum(64, 2 ** np.array([int(n).bit_length() + 1 if n else 0 for n in sizes.tolist()], dtype=np.int64))
    out: list[bytes] = [b""] * len(sizes)
    for width in np.unique(bits).tolist():
        rows = np.flatnonzero(bits == width)
        for part in np.array_split(rows, 1 + len(rows) * width // SKETCH_BYTES):
            at = np.repeat(np.arange(len(part)), sizes[part]) * width
            flips = np.bincount(at + (_gather(items, begin, part) & np.uint64(width - 1)).astype(np.int64), minlength=len(part) * width) & 1
            whole = np.packbits(flips.astype(np.uint8)).tobytes()
            for k, row in enumerate(part.tolist()):
                out[row] = whole[k * width // 8:(k + 1) * width // 8]
    return out


class Sketches:
    """The sketches and sizes of a task's members; ``may_link`` refuses no linked pair."""

    def __init__(self, sizes: np.ndarray, sketches: list[bytes], percent: int):
        self.sizes, self.percent = sizes, percent
        self.width = np.array([len(s) for s in sketches], dtype=np.int64)
        self._rows: dict[int, np.ndarray] = {}  # per width the sketches of at least that width, folded to it
        self._at: dict[int, np.ndarray] = {}
        wider = np.empty((0, 0), dtype=np.uint64)
        for width in sorted(set(self.width.tolist()), reverse=True):
            own = np.flatnonzero(self.width == width)
            fresh = np.frombuffer(b"".join(sketches[k] for k in own.tolist()), dtype=np.uint64).reshape(len(own), -1)
            if len(wider):
                wider = np.bitwise_xor.reduce(wider.reshape(len(wider), -1, width // 8), axis=1)
                fresh = np.concatenate([wider, fresh])
            order = np.concatenate([known, own]) if len(wider) else own
            at = np.full(len(sizes), -1, dtype=np.int64)
            at[order] = np.arange(len(order))
            self._rows[width], self._at[width] = fresh, at
            wider, known = fresh, order

    def may_link(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, m = self.sizes[i], self.sizes[j]
        fits = np.flatnonzero(100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))
        most = (n[fits] + m[fits]) * (100 - self.percent) // (100 + self.percent)
        narrow = np.minimum(self.width[i[fits]], self.width[j[fits]])
        keep = np.zeros(len(i), dtype=bool)
        for width in np.unique(narrow).tolist():
            of, rows, at = np.flatnonzero(narrow == width), self._rows[width], self._at[width]
            for part in np.array_split(of, 1 + len(of) * width // SKETCH_BYTES):
                x, y = at[i[fits[part]]], at[j[fits[part]]]
                keep[fits[part]] = np.bitwise_count(rows[x] ^ rows[y]).sum(axis=1) <= most[part]
        return keep


def are_linked(i: np.ndarray, j: np.ndarray, sets: Sets, percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, exactly."""
    items, begin = sets
    sizes = np.diff(begin)
    small, large = np.where(sizes[i] <= sizes[j], i, j), np.where(sizes[i] <= sizes[j], j, i)
    known, place = np.unique(large, return_inverse=True)
    table = _gather(items, begin, known) | (np.repeat(np.arange(len(known), dtype=np.uint64), sizes[known]) << np.uint64(48))
    asked = _gather(items, begin, small) | (np.repeat(place.astype(np.uint64), sizes[small]) << np.uint64(48))
    at = np.searchsorted(table, asked)
    hit = table[np.minimum(at, len(table) - 1)] == asked if len(table) else np.zeros(len(asked), dtype=bool)
    sums = np.concatenate([[0], np.cumsum(hit)])
    ends = np.cumsum(sizes[small])
    common = sums[ends] - sums[ends - sizes[small]]
    return (common > 0) & (100 * common >= percent * (sizes[i] + sizes[j] - common))


def _gather(items: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> np.ndarray:
    count = begin[rows + 1] - begin[rows]
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return items[np.repeat(begin[rows], count) + within]


def _join_linked(trees: Trees, i: np.ndarray, j: np.ndarray, sets: Sets, sketches: Sketches) -> None:
    """Unite the linked ones of the pairs; a pair whose trees have met meanwhile is not checked."""
    sizes = np.diff(sets[1])
    code = np.unique(np.minimum(i, j) * np.int64(len(sizes)) + np.maximum(i, j))
    i, j = code // len(sizes), code % len(sizes)
    keep = sketches.may_link(i, j)
    i, j = i[keep], j[keep]
    # By the items they hold; a portion has at most 65,536 members, whose number fits beside 48 bits.
    portion = np.cumsum(sizes[i] + sizes[j] + 100) // ITEMS
    for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(portion)) + 1):
        labels = trees.roots()
        part = part[labels[i[part]] != labels[j[part]]]
        if len(part):
            linked = are_linked(i[part], j[part], sets, sketches.percent)
            for a, b in zip(i[part][linked].tolist(), j[part][linked].tolist(), strict=True):
                trees.join(a, b)


def _carrying(rows: DataFrame, payloads: DataFrame) -> DataFrame:
    """What the members of each task carry: every member once, however many rows it has there."""
    tasks = rows.select(F.col("task").alias("to"), "id").distinct()
    return tasks.join(payloads, "id").select("to", F.col("id").alias("member"), *[c for c in payloads.columns if c != "id"])


def _members(rows: pa.Table, held: pa.Table) -> tuple[pa.Table, np.ndarray, Rows, np.ndarray]:
    """What a task's members carry, by id; the ids; the rows; and the number of each row's member."""
    held = held.sort_by("member")
    ids = np.asarray(held.column("member"))
    placed = Rows(rows)
    return held, ids, placed, np.searchsorted(ids, placed.ids)


def _freeing(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def freed(rows: pa.Table, held: pa.Table) -> pa.Table:
        out = run(rows, held)
        give_back()
        return out

    return freed


def _with_partners(members: DataFrame, sketches: DataFrame, percent: int, scratch: list[DataFrame]) -> DataFrame:
    """(id) of the members that sizes and sketches allow a linked partner in one of their groups."""

    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        held, ids, placed, who = _members(rows, held)
        known = Sketches(np.asarray(held.column("n")), held.column("sketch").to_pylist(), percent)
        found = np.zeros(len(ids), dtype=bool)

        def look(i: np.ndarray, j: np.ndarray) -> None:
            open_ = ~(found[i] & found[j]) & (i != j)
            i, j = i[open_], j[open_]
            near = known.may_link(i, j)
            found[i[near]] = found[j[near]] = True

        i, j = placed.leaders()
        look(who[i], who[j])
        # Members that have a partner need not meet one another, so they are all alike.
        for i, j in placed.pairs(np.where(found, -1, np.arange(len(ids)))[who]):
            look(who[i], who[j])
        return pa.table({"id": ids[found]})

    size = sketches.agg(F.sum(F.octet_length("sketch"))).first()[0] or 0
    rows = dealt(members.withColumn("w", F.lit(0)), size, scratch)
    carried = _carrying(rows, sketches)
    return rows.groupBy("task").cogroup(carried.groupBy("to")).applyInArrow(_freeing(run), "id bigint").distinct()


def _forest(members: DataFrame, payloads: DataFrame, build: Callable[[pa.Array], Sets], percent: int, scratch: list[DataFrame]) -> DataFrame:
    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        held, ids, placed, who = _members(rows, held)
        sets = build(held.column("payload").combine_chunks())
        sketches, trees = Sketches(np.diff(sets[1]), parity_sketches(sets), percent), Trees(len(ids))
        i, j = placed.leaders()
        _join_linked(trees, who[i], who[j], sets, sketches)
        for i, j in placed.pairs(trees.roots()[who]):
            _join_linked(trees, who[i], who[j], sets, sketches)
        roots = trees.roots()
        child = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.table({"a": ids[child], "b": ids[roots[child]]})

    size = payloads.select("id", F.octet_length("payload").alias("w"))
    rows = dealt(members.join(size, "id"), size.agg(F.sum("w")).first()[0] or 0, scratch)
    return rows.groupBy("task").cogroup(_carrying(rows, payloads).groupBy("to")).applyInArrow(_freeing(run), "a bigint, b bigint")


def link_components(
    members: DataFrame, sketches: DataFrame, payloads: Callable[[DataFrame], DataFrame], build: Callable[[pa.Array], Sets], percent: int,
) -> DataFrame:
    """(id, component) of all ids that have a link; ids without one are absent.

    ``members`` are (key, id) such that linked ids share a key, ``sketches`` has one (id, n, sketch) of each. ``payloads`` gives one
    (id, payload) of the ids it is asked for, ``build`` makes sets of a task's payloads. Two sets are linked when
    100 * intersection >= ``percent`` * union, exactly.
    """
    scratch: list[DataFrame] = []
    open_ = materialise(_with_partners(members, sketches, percent, scratch), "open")
    _clear(scratch)
    rest = materialise(members.join(open_, "id").select("key", "id"), "members")
    held = materialise(payloads(open_), "payloads")
    forest = materialise(_forest(rest, held, build, percent, scratch), "forests")
    _clear([*scratch, open_, rest, held])
    labels = materialise(components(forest), "components")
    discard(forest)
    return labels


def _clear(scratch: list[DataFrame]) -> None:
    for table in scratch:
        discard(table)
    scratch.clear()
