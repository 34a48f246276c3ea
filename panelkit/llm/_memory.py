"""Memory of the tasks' Python processes."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def lean(task):
    """``task``, a function for ``mapInArrow``, whose process returns what it no
    longer needs to the system at the task's end. Processes are used again by
    later tasks, and what one stage took would count beside the next one's."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
                trim(0)
    return run
