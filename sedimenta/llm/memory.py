"""Memory that a Python worker keeps between tasks, given back to the machine."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

_libc = ctypes.CDLL(ctypes.util.find_library("c") or None)


def give_back() -> None:
    """Free pages that neither Arrow nor the C library still needs; workers live on for the stages that follow."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A batch function that gives memory back when its task is done."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
