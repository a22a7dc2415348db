"""Memory of Python workers. Spark uses a worker again, also for other stages, and whatever it holds adds to its executor."""

from __future__ import annotations

import ctypes
import functools
import inspect

import pyarrow as pa


#: Groups of fewer bytes leave too little behind to look for.
LARGE_GROUP = 2_000_000


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def lean_batches(run):
    """A function of Arrow batches for ``mapInArrow`` that gives memory back when its task ends."""

    @functools.wraps(run)
    def call(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return call


def lean_groups(f):
    """A function of one or two Arrow tables for ``applyInArrow`` that gives memory back after each large group."""

    def called(*tables):
        try:
            return f(*tables)
        finally:
            if sum(t.nbytes for t in tables) > LARGE_GROUP:
                give_back()

    def one(table):
        return called(table)

    def two(left, right):
        return called(left, right)

    return one if len(inspect.signature(f).parameters) == 1 else two  # Spark looks at the number of arguments
