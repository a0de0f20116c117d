"""Words, shingles and character n-grams of Arrow text batches, hashed without a loop per word.

A batch's texts lie one after another in one byte buffer. Word boundaries come from a mask of that
buffer; the 64-bit hash of every word is a difference of prefix sums of a polynomial over random
byte values (all arithmetic is modulo 2**64). Equal hashes stand for equal words: with 10**9
distinct words the chance of a single collision is about 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are hashed at once; bounds the memory of a task, whatever the batch size.
SLICE_BYTES = 3_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_VALUES = _BYTE_VALUES.copy()
_LOWER_VALUES[ord("A"):ord("Z") + 1] = _BYTE_VALUES[ord("a"):ord("z") + 1]
#: The separators of words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, SLICE_BYTES), base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a binary column; a null is an empty text."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_null()), 0, np.diff(offsets))
        data = np.concatenate([data[a:a + n] for a, n in zip(offsets[:-1], lengths, strict=True)])
        return data, np.concatenate([[0], np.cumsum(lengths)])
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that no piece holds much over ``most`` bytes of text (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        size = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
        group = (np.cumsum(size) - size) // most
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 offsets of each text's words."""
    n = len(data)
    inside = np.empty(n + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER_VALUES if lower else _BYTE_VALUES)[data] * _power(_BASE, n), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * _power(_INVERSE, n + 1)[starts]
    return mix(raw), np.searchsorted(starts, offsets)


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive values (len - k + 1 of them), by doubling."""
    if len(values) < k:
        return np.empty(0, dtype=np.uint64)
    multiplier = 0xD1342543DE82EF95
    total, width = None, 0  # hash of the `width` values from each position
    power_hash, power = values, 1
    while True:
        if k & power:
            if total is None:
                total, width = power_hash, power
            else:
                m = len(values) - width - power + 1
                total = total[:m] * np.uint64(pow(multiplier, power, 2**64)) + power_hash[width:width + m]
                width += power
        if width == k:
            return mix(total[:len(values) - k + 1])
        m = len(values) - 2 * power + 1
        power_hash = power_hash[:m] * np.uint64(pow(multiplier, power, 2**64)) + power_hash[power:power + m]
        power *= 2


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of k words; a shorter text is one shingle."""
    every = rolling(hashes, k)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(every[a:b - k + 1]))
        elif b > a:
            out.append(rolling(hashes[a:b] + np.uint64(b - a), int(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
