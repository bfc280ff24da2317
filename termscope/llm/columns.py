"""Names for columns that operators add beside those of the input."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column in ``taken`` has it (in any case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name
