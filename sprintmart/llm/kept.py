"""Results that a worker process keeps from one batch to the next, and when it lets go of them."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_clear: dict[str, Callable[[], None]] = {}
_serving: list[str] = []


def keeper(name: str, clear: Callable[[], None]) -> None:
    """Note how to drop what an operator keeps in this process."""
    _clear[name] = clear


def claim(name: str) -> None:
    """Say which operator this process now works for. Spark hands processes on from stage to stage; what another
    operator has kept goes, and its memory with it."""
    if _serving == [name]:
        return
    _serving[:] = [name]
    for other, clear in _clear.items():
        if other != name:
            clear()
    release()


def release() -> None:
    """Give back memory that is free but still held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Kept(dict):
    """A bounded store of two generations. When the young one holds half the limit it becomes the old
    one, and what is asked for again moves back; frequent keys stay, and no key changes a result."""

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.half = limit // 2
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """Those keys that have to be worked out; all others can be read from this store now."""
        absent = keys.difference(self)
        if absent and len(self) + len(absent) > self.half:
            self.old = dict(self)
            self.clear()
            absent = keys
        old = self.old
        found = [key for key in absent if key in old]
        self.update((key, old[key]) for key in found)
        return list(absent.difference(found)) if found else list(absent)
