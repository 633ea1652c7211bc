"""0/1 flags and sums as SQL expressions."""

from __future__ import annotations

from collections.abc import Iterable


def nonzero_flag(count: str) -> str:
    """0 for zero, 1 for anything else; NULL also gives 1, as a decode with a default does."""
    return f"CASE WHEN {count} = 0 THEN 0 ELSE 1 END"


def add_up(terms: Iterable[str]) -> str:
    """Plain sum: NULL as soon as one term is NULL."""
    return "(" + " + ".join(terms) + ")"
