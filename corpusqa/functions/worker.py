"""State that lives as long as a Python worker process.

The package is shipped to workers by value, so a module-level variable starts
afresh with every task. What is dear to build (a loaded model, a tokenizer, a
memo of token ids) is kept in a module registered in the worker itself.
"""

from __future__ import annotations

import sys
import types
from typing import Any, Callable

_HOLDER = "corpusqa_worker_state"


def once_per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """The value made by ``make()`` the first time this worker asks for ``key``."""
    holder = sys.modules.get(_HOLDER)
    if holder is None:
        holder = sys.modules.setdefault(_HOLDER, types.ModuleType(_HOLDER))
        holder.values = {}
    if key not in holder.values:
        holder.values[key] = make()
    return holder.values[key]
