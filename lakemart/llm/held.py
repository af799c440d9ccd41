"""What a Python worker keeps from one task to the next: the tables of one operator at a time.

Spark gives a worker to one stage after another, so what a stage has learned would stay in memory through all stages
of a session. An operator that asks for its own tables, or says that it needs none, lets those of the others go.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """The tables kept under ``key``, made where there are none; any others go first."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Let all tables go."""
    _HELD.clear()
