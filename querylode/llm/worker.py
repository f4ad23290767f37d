"""What a Python worker keeps from task to task.

Functions travel to the workers by value, each task with modules of its own, so what one task stores in a module is out of the next
one's reach (and stays in memory until a collection finds it). One place outside of them lasts as long as the worker.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable

import pyarrow as pa

_HOME = "_kept_by_worker"


def _kept() -> dict:
    return sys.modules.setdefault(_HOME, types.ModuleType(_HOME)).__dict__.setdefault("kept", {})


def resident(key: tuple, build: Callable[[], object]) -> object:
    """One thing per worker: another key's goes first, so that memory does not add up over the operators of a job."""
    kept = _kept()
    if key not in kept:
        release()
        kept[key] = build()
    return kept[key]


def release() -> None:
    """Frees what the worker keeps and what earlier tasks left, and gives the pages back, Arrow's own ones too."""
    _kept().clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)
