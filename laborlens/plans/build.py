"""What the helpers share while one registered query is being built."""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

_BUILD: dict = {"active": False, "cache": {}}


def build_cache() -> dict | None:
    """Cache shared by the helpers while ONE registered query's DataFrame is
    being built (None outside a build).  Nothing survives between queries."""
    return _BUILD["cache"] if _BUILD["active"] else None


@contextmanager
def building() -> Iterator[None]:
    """A query's build; a query built within another shares its cache."""
    outer = not _BUILD["active"]
    if outer:
        _BUILD["active"], _BUILD["cache"] = True, {}
    try:
        yield
    finally:
        if outer:
            _BUILD["active"], _BUILD["cache"] = False, {}
