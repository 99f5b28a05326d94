"""What a Python worker keeps between its tasks.

Spark uses its Python workers again, for later tasks and later queries.  A
module that keeps something for the tasks after it (a model, mapped files)
takes a ``table`` by name; a task says with ``begin`` which tables it uses, and
what an earlier operator left in the others goes, its memory back to the
system.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

_tables: dict[str, dict] = {}


def table(name: str) -> dict:
    """The table of that name, kept until a task begins that doesn't use it."""
    return _tables.setdefault(name, {})


def begin(*names: str) -> None:
    """Drop everything but the tables that this task uses."""
    others = [t for name, t in _tables.items() if name not in names and t]
    for t in others:
        t.clear()
    if others:
        trim()


def trim() -> None:
    """Give freed memory back: Arrow's, which has a pool of its own, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def tidy(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that gives back what it freed when it ends: an idle worker keeps little."""

    @wraps(run)
    def task(*args):
        try:
            yield from run(*args)
        finally:
            trim()

    return task
