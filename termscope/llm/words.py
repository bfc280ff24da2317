"""Words of a text as 64-bit hashes, with a bounded per-worker memory."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
_KEPT = 1 << 17
_known: dict[str, int] = {}


def hashes(words: list[str]) -> np.ndarray:
    """The words' xxHash64 values in order."""
    if len(_known) > _KEPT:
        _known.clear()
    for w in words:
        if w not in _known:
            _known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
