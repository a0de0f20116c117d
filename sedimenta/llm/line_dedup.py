"""Fuzzy line dedup by MinHash.

A line's set is its distinct character shingles. MinHash signatures are cut into bands so that two lines over
the threshold share a band almost surely. Two bits of every minimum go beside the keys: where bands meet, they tell lines that
share one by chance, so that only the others are written; these are verified by their exact
Jaccard similarity and united by distributed union-find. One line of each component stays: the first by
document and place. Equal lines are one line from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.cells import Sets, link_components, parity_sketches
from sedimenta.llm.hashing import mix, rolling, slices
from sedimenta.llm.links import GROUP_KEYS, KEY_BLOB, Alike, bit_hits, blob_batch, ids_table, marked_blobs, shared_keys
from sedimenta.llm.memory import giving_back
from sedimenta.session import discard, materialise

#: Bands and rows: at a similarity of 0.75 a pair is missed once in 95, at 0.8 once in 560, whatever the shingles.
BANDS, ROWS = 12, 4
#: Characters of a shingle by default, and of a short one. A changed character takes away as many shingles, so at 0.8
#: lines that differ in one meet from 119 characters on by the first and from 49 on by the second.
SHINGLE, SHORT_SHINGLE = 12, 5
#: Shorter lines are left alone: they are equal by chance.
MIN_CHARS = 24
#: Characters that are hashed at once: their arrays stay in the processor's cache.
BLOCK_CHARS = 64_000
#: Words of a line's mark, and the share of linked lines (at the threshold) that marks may refuse in a band they share.
MARK_WORDS, MISSED = BANDS * ROWS // 16, 1e-7
_FACTORS = np.random.default_rng(11).integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _lines(texts: list[str | None], min_chars: int) -> tuple[np.ndarray, list[tuple[int, int, str]]]:
    """Ids (hashes) of the lines that take part, and (text, line number, stripped line) of each."""
    found = [(t, k, s) for t, text in enumerate(texts) for k, line in enumerate((text or "").split("\n")) if len(s := line.strip()) >= min_chars]
    ids = [int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little", signed=True) for _, _, s in found]
    return np.array(ids, dtype=np.int64), found


def _shingles(lines: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character shingles of the lines, in order, and where each line's begin."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    every = rolling(mix(chars.astype(np.uint64)), shingle)
    size = np.array([len(s) for s in lines])
    start = np.cumsum(size) - size
    count = size - shingle + 1
    begin = np.cumsum(count) - count
    inner = np.arange(count.sum()) - np.repeat(begin, count)
    return every[np.repeat(start, count) + inner], begin


def _blocks(lines: list[str]) -> Iterator[list[str]]:
    """Consecutive lines of BLOCK_CHARS characters or a line more."""
    block, size = [], 0
    for line in lines:
        block.append(line)
        size += len(line)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def line_sets(lines: list[str], shingle: int) -> Sets:
    """The distinct shingles of every line, 48 bits each."""
    items, sizes = [np.empty(0, dtype=np.uint64)], []
    for block in _blocks(lines):
        hashes, begin = _shingles(block, shingle)
        row = np.repeat(np.arange(len(block), dtype=np.uint64), np.diff(np.append(begin, len(hashes))))
        whole = np.sort((row << np.uint64(48)) | (hashes >> np.uint64(16)))
        whole = whole[np.append(True, whole[1:] != whole[:-1])]
        sizes.append(np.bincount((whole >> np.uint64(48)).astype(np.int64), minlength=len(block)))
        items.append(whole & np.uint64((1 << 48) - 1))
    return np.concatenate(items), np.concatenate([[0], np.cumsum(np.concatenate(sizes or [[]])).astype(np.int64)])


def minima(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(lines x bands * rows): the least of each line's shingles under different orders."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat(low * factor, begin) for factor in _FACTORS], axis=1)


def band_keys(least: np.ndarray) -> np.ndarray:
    """(lines x bands) keys: ROWS minima make one."""
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None], len(least), axis=0)
    for row in range(ROWS):
        keys = mix(keys ^ least[:, row::ROWS])
    return keys


def line_marks(least: np.ndarray) -> np.ndarray:
    """(lines x MARK_WORDS) words with two bits of every minimum."""
    bits = (least * np.uint32(0x9E3779B1)) >> np.uint32(30)
    return np.bitwise_or.reduce(bits.reshape(len(least), MARK_WORDS, 16) << np.arange(0, 32, 2, dtype=np.uint32), axis=2)


def least_alike(percent: int) -> int:
    """How many of the minima of two lines must agree in their two bits, so that of linked lines that share a band, whose ROWS
    minima agree anyway, fewer than MISSED are refused."""
    rest, p = (BANDS - 1) * ROWS, percent / 100 + (1 - percent / 100) / 4
    below, agree = 0.0, 0
    while agree <= rest and (below := below + comb(rest, agree) * p ** agree * (1 - p) ** (rest - agree)) <= MISSED:
        agree += 1
    return ROWS + agree


def marks_alike(percent: int) -> Alike:
    """Whether lines with these marks may be linked."""
    most = BANDS * ROWS - least_alike(percent)

    def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        other = a ^ b
        other = (other | (other >> np.uint32(1))) & np.uint32(0x55555555)
        apart = np.bitwise_count(other).sum(axis=1)
        return (apart <= most) | ~a.any(axis=1) | ~b.any(axis=1)

    return alike


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
                   min_chars: int = MIN_CHARS, shingle: int = SHINGLE, filter_bits: int = 1 << 24) -> DataFrame:
    """(id, gone): the numbers of each document's lines that repeat, fuzzily, an earlier line."""
    if min_chars < shingle:
        raise ValueError(f"lines need {shingle} characters at least")
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    size = named.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + int(size / 25) // (GROUP_KEYS // 2)  # a key for every 25 characters or so, and its mark

    def distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
        ids, found = _lines(batch.column("text").to_pylist(), min_chars)
        ids, first = np.unique(ids, return_index=True)
        return ids, [found[k][2] for k in first]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            docs = np.asarray(batch.column("id")).astype(np.int64)
            ids, found = _lines(batch.column("text").to_pylist(), min_chars)
            at = docs[[t for t, _, _ in found]] if found else docs[:0]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(at), pa.array([k for _, k, _ in found], pa.int64())], names=["line", "id", "k"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(slices(batches)):
            ids, lines = distinct(batch)
            if lines:
                least = np.concatenate([minima(*_shingles(block, shingle)) for block in _blocks(lines)])
                marks = np.repeat(line_marks(least), BANDS, axis=0)
                yield blob_batch(list(marked_blobs(np.repeat(ids, BANDS), band_keys(least).reshape(-1), marks, parts, turn + int(ids[0]))))

    def pick(table: np.ndarray, sketch: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                ids, lines = distinct(batch)
                at = np.flatnonzero(bit_hits(table, ids.view(np.uint64))) if len(ids) else ids
                if not len(at):
                    continue
                chosen = [lines[k] for k in at]
                if sketch:
                    sets = line_sets(chosen, shingle)
                    more = {"n": pa.array(np.diff(sets[1])), "sketch": pa.array(parity_sketches(sets), pa.binary())}
                else:
                    more = {"payload": pa.array(chosen, pa.string())}
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids[at])} | more)

        return giving_back(run)

    def picked(ids: DataFrame, sketch: bool = False) -> DataFrame:
        schema = "id bigint, n bigint, sketch binary" if sketch else "id bigint, payload string"
        # The table lets some other lines pass, which no row asks for.
        return named.mapInArrow(pick(ids_table(ids, filter_bits), sketch), schema).dropDuplicates(["id"])

    members = materialise(shared_keys(named.mapInArrow(giving_back(emit), KEY_BLOB), parts, MARK_WORDS, marks_alike(percent)), "members")
    sketches = materialise(picked(members.select("id"), sketch=True), "sketches")
    labels = link_components(members, sketches, picked, lambda lines: line_sets(lines.to_pylist(), shingle), percent)
    discard(members)
    discard(sketches)
    seen = materialise(named.mapInArrow(giving_back(places), "line bigint, id bigint, k bigint"), "lines")
    first = seen.groupBy("line").agg(F.min(F.struct("id", "k")).alias("first"), F.count("*").alias("n"))
    # Lines that occur once and resemble no other are done with.
    first = first.join(labels.withColumnRenamed("id", "line"), "line", "left").where("n > 1 or component is not null")
    first = materialise(first.select("line", "first", "n", F.coalesce("component", "line").alias("component")), "firsts")
    stay = first.groupBy("component").agg(F.min("first").alias("stay"), F.sum("n").alias("all")).where("all > 1")
    stay = materialise(first.join(stay, "component").select("line", "stay"), "stays")
    gone = seen.join(stay, "line").where("id <> stay.id or k <> stay.k")
    return gone.groupBy("id").agg(F.sort_array(F.collect_set("k")).alias("gone"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, min_chars: int = MIN_CHARS,
                shingle: int = SHINGLE, filter_bits: int = 1 << 24) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and n_lines and n_removed.

    Lines are split at newlines and compared without blanks at their ends; lines under ``min_chars`` characters stay.
    A null text stays null and has no lines, an empty one has one. Rows with a null id are not changed and no
    witnesses; rows that repeat an id are treated as one document and lose the same lines. Columns named
    n_lines or n_removed are replaced, all others are kept; an empty table gives an empty result.
    """
    gone = repeated_lines(docs, id_col=id_col, text_col=text_col, percent=percent, min_chars=min_chars, shingle=shingle,
                         filter_bits=filter_bits)
    marks = materialise(gone.select(F.col("id").alias("_line_owner"), F.col("gone").alias("_lines_gone")), "gone")
    table = ids_table(marks.select(F.col("_line_owner").alias("id")), filter_bits)

    def touched(ids: pa.Array) -> pa.Array:
        at = np.asarray(pc.fill_null(ids, 0)).astype(np.int64)
        return pc.and_(pa.array(bit_hits(table, at.view(np.uint64))), pc.is_valid(ids))

    # Only texts that may lose a line are shuffled; the table lets some others pass, which the join leaves as they are.
    owner = F.col(id_col).cast("bigint")
    hit, rows = F.arrow_udf(touched, "boolean")(owner), docs.drop("n_lines", "n_removed")
    others = rows.where(~hit).withColumns({"_line_owner": F.lit(None).cast("bigint"), "_lines_gone": F.lit(None).cast("array<bigint>")})
    # The marks grow with the texts and take ten times their file in memory: Spark would broadcast what it takes for small.
    rows = rows.where(hit).join(marks.hint("merge"), owner == F.col("_line_owner"), "left").unionByName(others)
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(lines, lambda _, k: ~F.array_contains(F.col("_lines_gone"), k.cast("bigint")))
    rows = rows.withColumn("n_lines", F.coalesce(F.when(F.col(text_col).isNotNull(), F.size(lines)), F.lit(0)).cast("bigint"))
    rows = rows.withColumn("n_removed", F.coalesce(F.size("_lines_gone"), F.lit(0)).cast("bigint"))
    text = F.when(F.col("n_removed") > 0, F.concat_ws("\n", kept)).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).drop("_line_owner", "_lines_gone")
