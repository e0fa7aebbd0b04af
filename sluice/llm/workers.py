"""Memory of Python workers, which Spark uses again for later tasks and stages."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return memory that is free in this worker to the system.

    Arrow's pool and the C library keep what large batches took; a worker that waits for
    its next task would hold it next to the executor's heap. Where the C library has no
    such call, only Arrow's share goes back.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
