"""Freed memory of Python workers, which outlive a task and share an executor."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa


def give_back() -> None:
    """Return freed memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def tidy_pair(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable:
    """``run`` for a cogroup, whose worker holds no freed memory after a group."""

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        give_back()
        return out

    return whole
