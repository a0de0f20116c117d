"""Merkle manifest of a dataset: per-row inclusion proofs that grow while leaves are appended.

Each group of rows (a source) is a tree whose leaves ascend by id; every ``arity`` consecutive nodes
become their parent and a short last run, even of one node, does the same. The roots of the groups
are the leaves of one more tree of the same kind.

``WitnessTree`` takes leaves one after another. A leaf starts with an empty witness; when the run
around a subtree is complete, the siblings are appended to the witnesses of all leaves below it. A
distributed tree cuts the leaves of a group at multiples of ``arity ** levels``, so that a block is a
whole subtree of that height. Tasks append the leaves of their blocks; the roots of the blocks are then
appended to the tree above them in the same way, and what that adds to the witness of a block root is
added to the witness of every leaf of the block. No task holds more leaves than a block has, also
where one group has most of the rows.

Rows are data, not identities: rows that repeat an id, or have none, are leaves of their own. They stand
in the order (id, nulls first; leaf digest), and equal rows get the proofs of their places. A null
group is a group of its own. An empty table has no root and gives no rows. Other columns take no part,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators import ordered
from sedimenta.session import materialise

#: Height of the subtree that a task builds: 3 ** 8 = 6,561 leaves.
BLOCK_LEVELS = 8
#: Rows that a task returns at a time.
BATCH_ROWS = 8_192

WITNESS = "array<struct<left: string, right: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class WitnessTree:
    """A tree that leaves are appended to; ``witness[i]`` lists the siblings of leaf i, level by level.

    An entry holds the digests left and right of the path. Only the open runs, fewer than ``arity`` subtrees
    per level, are kept beside the witnesses.
    """

    def __init__(self, arity: int = 3):
        if arity < 2:
            raise ValueError("arity must be 2 or more")
        self.arity = arity
        self.witness: list[list[tuple[str, str]]] = []
        self._open: list[list[tuple[str, int, int]]] = []  # per level: digest, first leaf, end

    def append(self, leaf: str) -> None:
        at = len(self.witness)
        self.witness.append([])
        self._add(0, (leaf, at, at + 1))

    def _add(self, level: int, subtree: tuple[str, int, int]) -> None:
        if level == len(self._open):
            self._open.append([])
        self._open[level].append(subtree)
        if len(self._open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        digests = [d for d, _, _ in run]
        for i, (_, first, end) in enumerate(run):
            entry = ("".join(digests[:i]), "".join(digests[i + 1:]))
            for leaf in range(first, end):
                self.witness[leaf].append(entry)
        self._add(level + 1, (digest("".join(digests)), run[0][1], run[-1][2]))

    def seal(self) -> tuple[str, int]:
        """Complete the short runs; the root and its height. Nothing can be appended afterwards."""
        level = 0
        while len(self._open[level]) != 1 or any(self._open[level + 1:]):
            if self._open[level]:
                self._complete(level)
            level += 1
        return self._open[level][0][0], level


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf digest and its witness lead to."""
    return F.aggregate(witness, leaf, lambda acc, w: F.sha2(F.concat(w["left"], acc, w["right"]), 256))


def siblings(witness: Column) -> Column:
    """All digests of a witness in one text, level by level and left to right."""
    return F.array_join(F.transform(witness, lambda w: F.concat(w["left"], w["right"])), "")


def leaf_digest(columns: list[Column]) -> Column:
    """The digest of a row: every value with its number of bytes in front, ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def manifest(
    rows: DataFrame, *, leaf: Column, group: Column, order: Column, keep: dict[str, Column] | None = None,
    arity: int = 3, levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``rows``: the columns of ``keep``, ``leaf``, ``subroot``, ``root`` and ``witness``."""
    keep = keep or {}
    chosen = [c.alias(f"k_{name}") for name, c in keep.items()]
    # Text before any group name but the one of the null group, so that groups need no null-safe joins.
    named = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = materialise(rows.select(named.alias("g"), order.alias("o"), leaf.alias("digest"), *chosen), "merkle-leaves")
    numbered = _numbered(leaves, ["g"], [("o", "asc")], ["digest"]).drop("o")
    proved, subroots = _witnesses(numbered, arity, levels)

    tops = _numbered(materialise(subroots, "merkle-subroots"), [], [("g", "asc")], [])
    upper, root = _witnesses(tops.select(F.lit("").alias("g"), "pos", "digest", F.col("g").alias("k_of")), arity, levels)
    found = root.first()  # the root of the only group
    top = F.lit(found["digest"] if found else None).cast("string")
    above = upper.select(F.col("k_of").alias("g"), F.col("digest").alias("subroot"), F.col("witness").alias("_above"))
    whole = F.concat("witness", "_above").alias("witness")
    kept = [F.col(f"k_{name}").alias(name) for name in keep]
    return proved.join(above, "g").select(*kept, F.col("digest").alias("leaf"), "subroot", top.alias("root"), whole)


def document_manifest(docs: DataFrame, arity: int = 3, levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of ``documents``, and whether each row still proves to belong to it after tampering.

    Where 2 divides the CRC-32 of the decimal id, line feeds are deleted from the text before the row is checked.
    A null text or id stays as it is.
    """
    fields = ["doc_id", "source", "lang", "n_chars"]
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    later = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    keep = {"doc_id": F.col("doc_id"), "_seen": leaf_digest([*map(F.col, fields), later])}
    proved = manifest(
        docs, leaf=leaf_digest([F.col(c) for c in [*fields, "text"]]), group=F.col("source"), order=F.col("doc_id"),
        keep=keep, arity=arity, levels=levels)
    folded = proved.withColumn("folded_root", fold(F.col("_seen"), F.col("witness")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("witness")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _numbered(rows: DataFrame, group: list[str], order: list[tuple[str, str]], ties: list[str]) -> DataFrame:
    """Add ``pos``, the place in the group from 0, without gathering a group in one task."""
    found = ordered.ordered_window(
        rows, {"pos": ordered.row_number()}, order_by=order, tiebreak=ties, partition_by=group)
    return found.withColumn("pos", F.col("pos").cast("bigint") - 1)


def _witnesses(nodes: DataFrame, arity: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """The nodes (g, pos, digest, more) with their witness in the tree of their group, and the roots (g, digest)."""
    size = arity**levels
    blocks = nodes.withColumn("block", F.expr(f"pos div {size}L"))
    dealt = blocks.repartition("g", "block").sortWithinPartitions("g", "block", "pos")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    grown = dealt.mapInArrow(_append_blocks(arity), f"{schema}, witness {WITNESS}, top string, height int")
    local = materialise(grown, "merkle-blocks")
    tops = local.where(F.col("top").isNotNull()).select("g", "block", "top", "height")
    last = tops.groupBy("g").agg(F.max("block").alias("last"))
    if (last.agg(F.max("last")).first()[0] or 0) == 0:
        return local.drop("block", "top", "height"), tops.select("g", F.col("top").alias("digest"))

    # The last block of a group of several is lifted to the height of the others, one lone node a level.
    lift = F.when(F.col("last") > 0, levels - F.col("height")).otherwise(0)
    lifted = reduce(
        lambda d, i: F.when(F.col("lift") > i, F.sha2(d, 256)).otherwise(d), range(levels), F.col("top"))
    roots = tops.join(last, "g").withColumn("lift", lift)
    above = roots.select("g", F.col("block").alias("pos"), lifted.alias("digest"), F.col("lift").alias("k_lift"))
    upper, out = _witnesses(above, arity, levels)
    lone = F.struct(F.lit("").alias("left"), F.lit("").alias("right"))
    rest = upper.select(
        "g", F.col("pos").alias("block"), F.concat(F.array_repeat(lone, F.col("k_lift")), F.col("witness")).alias("_rest"))
    whole = local.drop("top", "height").join(rest, ["g", "block"])
    return whole.withColumn("witness", F.concat("witness", "_rest")).drop("block", "_rest"), out


def _append_blocks(arity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows read and not returned
        made: list[list] = [[], [], []]  # witness, top, height of the sealed blocks among them
        tree, key = None, None

        def seal() -> None:
            top, height = tree.seal()
            made[0].extend(tree.witness)
            made[1].extend([top, *[None] * (len(tree.witness) - 1)])
            made[2].extend([height, *[None] * (len(tree.witness) - 1)])

        def ready() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            n = len(made[0])
            held[:] = rows.slice(n).to_batches()
            entry = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            as_rows = [[{"left": a, "right": b} for a, b in w] for w in made[0]]
            new = [pa.array(as_rows, entry), pa.array(made[1], pa.string()), pa.array(made[2], pa.int32())]
            for column in made:
                column.clear()
            out = rows.slice(0, n)
            for name, values in zip(("witness", "top", "height"), new, strict=True):
                out = out.append_column(name, values)
            return out.combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            columns = (batch.column(c).to_pylist() for c in ("g", "block", "digest"))
            for group, block, leaf in zip(*columns, strict=True):
                if (group, block) != key:
                    if tree is not None:
                        seal()
                    tree, key = WitnessTree(arity), (group, block)
                tree.append(leaf)
            if len(made[0]) >= BATCH_ROWS:
                yield ready()
        if tree is not None:
            seal()
            yield ready()

    return run
