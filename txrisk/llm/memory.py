"""Giving a task's memory back: Python workers are reused, and what one stage leaves in them adds to the next."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def release() -> None:
    """Free objects in cycles, what Arrow keeps for later, and what the C library keeps (where it is glibc)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, with its memory given back when a task is done."""

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied
