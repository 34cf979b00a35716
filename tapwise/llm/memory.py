"""What a Python worker holds between tasks."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Returns freed memory to the system. A worker is kept for the next task, beside others on its executor, and
    would else hold the most that it ever needed. Does nothing more than Arrow can where the C library has no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
