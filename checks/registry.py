"""Where queries and their SQL register by name."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register the function under its own name; without SQL only its rows are checked."""

    def register(fn: Callable) -> Callable:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register
