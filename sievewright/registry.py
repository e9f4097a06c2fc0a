"""Extension points: named functions by kind, added with a decorator."""

from __future__ import annotations

from collections.abc import Callable

_KNOWN: dict[str, dict[str, Callable]] = {}


def register(kind: str, name: str) -> Callable[[Callable], Callable]:
    def add(function: Callable) -> Callable:
        _KNOWN.setdefault(kind, {})[name] = function
        return function

    return add


def find(kind: str, name: str) -> Callable:
    """The function, or ValueError."""
    try:
        return _KNOWN.get(kind, {})[name]
    except KeyError:
        raise ValueError(f"unknown {kind}: {name!r}; known: {', '.join(sorted(_KNOWN.get(kind, {})))}") from None


def known(kind: str) -> dict[str, Callable]:
    return dict(_KNOWN.get(kind, {}))
