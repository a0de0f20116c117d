"""Keys that two or more ids hold, and bit tables of fixed size.

A caller gives every set some 64-bit keys such that two linked sets share one; `shared_keys` finds the
keys that two or more sets hold. What shares a key is compared in `cells`. Where sets also meet by chance, whose number
grows faster than the sets, the caller puts a mark beside every key: a member none of whose group has a mark
alike is refused where the keys meet, before anything is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.hashing import mix
from sedimenta.llm.memory import give_back

#: Keys that meet in one group of `shared_keys`.
GROUP_KEYS = 2_000_000

#: Ids of a slice that hold a key and still go on to its range one by one; members of a group that are compared by marks.
CROWD, COMPARED = 16, 256

KEY_BLOB = "part int, blob binary"

#: Whether the marks (rows of 32-bit words) of two arrays are alike, row by row.
Alike = Callable[[np.ndarray, np.ndarray], np.ndarray]


def key_blobs(ids: np.ndarray, keys: np.ndarray, parts: int, salt: int) -> Iterator[tuple[int, bytes]]:
    """Pack a slice's (id, key) pairs by key range for `shared_keys`.

    Keys that several ids of the slice hold are handed on at once (negative parts) and only their
    first id goes on to the range of the key, so a key held by a third of all rows fills no group.
    """
    order = np.lexsort((ids, keys))
    ids, keys = ids[order], keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    ids, keys = ids[fresh], keys[fresh]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    many = np.diff(np.append(np.flatnonzero(first), len(keys))) > 1
    local = np.repeat(many, np.diff(np.append(np.flatnonzero(first), len(keys))))
    if local.any():
        yield -1 - salt % parts, keys[local].tobytes() + ids[local].tobytes()
    ids, keys = ids[first], keys[first]
    part = _part(keys, parts)
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
        if a < b:
            known, place = np.unique(ids[a:b], return_inverse=True)
            yield int(part[a]), (np.int64(len(known)).tobytes() + known.astype(np.int64).tobytes()
                                 + keys[a:b].astype(np.uint32).tobytes() + place.astype(np.uint32).tobytes())


def marked_blobs(ids: np.ndarray, keys: np.ndarray, marks: np.ndarray, parts: int, salt: int) -> Iterator[tuple[int, bytes]]:
    """Pack a slice's (id, key) pairs, no pair twice, each with its mark, by key range for `shared_keys`.

    No mark stands for another, so ids that share a key here go on to its range all the same. Only a key that more than
    CROWD of them hold is handed on at once, as in `key_blobs`; its first id goes on with a mark of zeros, which is like any other.
    """
    order = np.lexsort((ids, keys))
    ids, keys, marks = ids[order], keys[order], marks[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    crowded = np.repeat(sizes > CROWD, sizes)
    if crowded.any():
        yield -1 - salt % parts, keys[crowded].tobytes() + ids[crowded].tobytes()
        marks[crowded] = 0
        on = ~crowded
        on[starts] = True
        ids, keys, marks = ids[on], keys[on], marks[on]
    part = _part(keys, parts)
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
        yield int(part[a]), ids[a:b].tobytes() + keys[a:b].astype(np.uint32).tobytes() + marks[a:b].tobytes()


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def blob_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "blob"])


def _meet(table: pa.Table) -> pa.Table:
    """The (key, id) pairs of a group whose key two ids hold. Within a range the key's low half is enough:
    a chance meeting only makes a pair that the exact check refuses."""
    part, keys, ids = table.column(0)[0].as_py(), [], []
    for blob in table.column(1).to_pylist():
        if part < 0:
            n = len(blob) // 16
            keys.append(np.frombuffer(blob, np.uint64, n))
            ids.append(np.frombuffer(blob, np.int64, n, 8 * n))
        else:
            known = int(np.frombuffer(blob, np.int64, 1)[0])
            n = (len(blob) - 8 - 8 * known) // 8
            keys.append(np.frombuffer(blob, np.uint32, n, 8 + 8 * known))
            ids.append(np.frombuffer(blob, np.int64, known, 8)[np.frombuffer(blob, np.uint32, n, 8 + 8 * known + 4 * n)])
    keys, ids = np.concatenate(keys), np.concatenate(ids)
    if part < 0:  # the same form of key as below
        low = keys & np.uint64(0xFFFFFFFF)
        keys = (_part(keys, _meet_parts(table)).astype(np.uint64) << np.uint64(32)) | low
        return pa.table({"key": keys.view(np.int64), "id": ids})
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[fresh], ids[fresh]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[1:] == keys[:-1]
    keep = same[1:] | same[:-1]
    wide = keys[keep].astype(np.uint64) | (np.uint64(part) << np.uint64(32))
    return pa.table({"key": wide.view(np.int64), "id": ids[keep]})


def _meet_marked(table: pa.Table, words: int, alike: Alike) -> pa.Table:
    """The (key, id) pairs of a range of keys whose mark is like that of another id with the key."""
    part, keys, ids, marks = table.column(0)[0].as_py(), [], [], []
    for blob in table.column(1).to_pylist():
        n = len(blob) // (12 + 4 * words)
        ids.append(np.frombuffer(blob, np.int64, n))
        keys.append(np.frombuffer(blob, np.uint32, n, 8 * n))
        marks.append(np.frombuffer(blob, np.uint32, n * words, 12 * n).reshape(n, words))
    keys, ids, marks = np.concatenate(keys), np.concatenate(ids), np.concatenate(marks)
    # Keys that occur once are done with.
    order = np.sort((keys.astype(np.uint64) << np.uint64(32)) | np.arange(len(keys), dtype=np.uint64))
    same = np.concatenate([[False], (order[1:] ^ order[:-1]) >> np.uint64(32) == 0, [False]])
    order = (order[same[1:] | same[:-1]] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    order = order[np.lexsort((ids[order], keys[order]))]
    keys, ids, marks = keys[order], ids[order], marks[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    if len(starts):
        whole = np.logical_or.reduceat(~marks.any(axis=1), starts)
        fresh = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
        sizes = np.add.reduceat(fresh, starts, dtype=np.int64)
        keys, ids, marks = keys[fresh], ids[fresh], marks[fresh]
        end = np.repeat(np.cumsum(sizes), sizes)
        keep = np.repeat((whole | (sizes > COMPARED)) & (sizes > 1), sizes)
        step, i = 1, np.flatnonzero(np.arange(1, len(ids) + 1) < end)
        while len(i):
            left = i[~(keep[i] & keep[i + step])]
            left = left[alike(marks[left], marks[left + step])]
            keep[left] = keep[left + step] = True
            step += 1
            i = i[i + step < end[i]]
        keys, ids = keys[keep], ids[keep]
    wide = keys.astype(np.uint64) | (np.uint64(part) << np.uint64(32))
    return pa.table({"key": wide.view(np.int64), "id": ids})


def _meet_parts(table: pa.Table) -> int:
    return table.column("parts")[0].as_py()


def shared_keys(blobs: DataFrame, parts: int, words: int = 0, alike: Alike | None = None) -> DataFrame:
    """(key, id) of every key that at least two ids hold. ``blobs`` are rows of `key_blobs`.

    With ``alike`` they are rows of `marked_blobs`, of marks of ``words`` words, and ids whose mark is like that of no other
    id with the key are left out; groups of more than COMPARED ids and those a slice handed on at once are whole.
    """
    def meet(table: pa.Table) -> pa.Table:
        marked = alike is not None and table.column(0)[0].as_py() >= 0
        out = _meet_marked(table, words, alike) if marked else _meet(table)
        give_back()
        return out

    grouped = blobs.withColumn("parts", F.lit(parts)).groupBy("part")
    return grouped.applyInArrow(meet, "key bigint, id bigint").distinct()


def bit_table(spark: SparkSession, values: DataFrame, bits: int) -> np.ndarray:
    """A packed table of ``bits`` bits on the driver with the bits of ``values`` (one column, in [0, bits)) set.

    Its size is fixed by ``bits``. Tables like this only choose an order or save work: where more values
    than bits come together, more of them are looked at, and results stay the same.
    """
    table = np.zeros(bits // 8, dtype=np.uint8)
    value = F.col(values.columns[0]) + 1
    rows = values.groupBy(F.bitmap_bucket_number(value).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("m"))
    for row in rows.collect():  # bits / 32768 rows at most
        piece = np.frombuffer(bytes(row.m), dtype=np.uint8)
        at = (row.b - 1) * 4096
        table[at:at + len(piece)] = piece[:len(table) - at]
    return table


def bit_place(values: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each 64-bit value in a table of ``bits`` (a power of two)."""
    return (mix(values ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - int(bits).bit_length() + 1)).astype(np.int64)


def bit_hits(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = bit_place(values, len(table) * 8)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def ids_table(ids: DataFrame, bits: int) -> np.ndarray:
    """The bit table of a frame's ids."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bit_place(np.asarray(batch.column(0)).astype(np.int64).view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    return bit_table(ids.sparkSession, ids.select("id").mapInArrow(places, "at bigint"), bits)
