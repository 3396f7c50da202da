"""Memory of Python workers, which Spark keeps between tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def trim() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(f: Callable) -> Callable:
    """A task function over batches that gives its memory back when it ends; an idle worker then holds little."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            trim()

    return run
