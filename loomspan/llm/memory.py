"""What a Python worker keeps between tasks, and giving it back.

Workers serve one stage after another and free memory goes back to the system only on request, so a
stage with large arrays of its own first drops what earlier ones have left."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable

import pyarrow as pa

_kept: list[Callable[[], object]] = []


def on_release(drop: Callable[[], object]) -> None:
    """Register what drops a memory that only saves time."""
    _kept.append(drop)


def release() -> None:
    for drop in _kept:
        drop()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)
