"""What a Python worker keeps from task to task: one large object at a time, and no freed memory."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from time import monotonic
from typing import Any

import pyarrow as pa

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

BETWEEN = 0.1  # seconds from one trim to the next
_held: dict[str, Any] = {}


def kept(key: str, make: Callable[[], Any]) -> Any:
    """The object of that key, made anew if another one was kept last."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def trimmed() -> None:
    """Gives the system back what Arrow's pool and the C library hold after it was freed:
    beside the executor's JVM, that counts as much as what is in use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's alone
    if trim:
        trim(0)


def let_go(key: str | None = None) -> None:
    """Drops what is kept under other keys."""
    for other in [k for k in _held if k != key]:
        del _held[other]


def lean(step: Step, key: str | None = None) -> Step:
    """A step that first lets go of what another one kept (all but key), and hands freed
    memory back when it ends and after its batches, small ones now and then."""

    @wraps(step)
    def leanly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(key)
        trimmed()
        last = monotonic()
        for found in step(batches):
            yield found
            del found
            if monotonic() - last > BETWEEN:
                trimmed()
                last = monotonic()
        trimmed()

    return leanly
