"""What a Python worker keeps between tasks: models, vocabularies and what is remembered with them.

A worker serves one operator after another. It keeps the things of one operator only, so that a worker that has run all
stages of a pipeline is no larger than one that has run the last.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

_kept: dict[Hashable, Any] = {}
_operator: list[str] = []


def kept[Thing](operator: str, key: Hashable, make: Callable[[], Thing]) -> Thing:
    """The thing that `make` gives for `key`, made once while no other operator asks for one."""
    if _operator != [operator]:
        _kept.clear()
        _operator[:] = [operator]
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the collector of cycles, for work that makes very many objects and no cycle: it would look at all of them
    again and again."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()
