"""Words, their 64-bit hashes and shingles over them, for whole Arrow batches at a time."""

from __future__ import annotations

import re

import numpy as np

_WORD = re.compile(r"\w+")
#: Words whose hash a worker remembers; the store is emptied when full, which changes no result.
REMEMBERED = 500_000
_HASHES: dict[str, int] = {}

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words(text: str) -> list[str]:
    """Maximal runs of letters, digits and underscores of the lower-cased text."""
    return _WORD.findall(text.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x + _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


def hashes(tokens: list[str]) -> np.ndarray:
    """The 64-bit hash of each word, the same on every worker."""
    import xxhash

    known = _HASHES
    try:
        return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        one = xxhash.xxh3_64_intdigest
        for w in set(tokens):
            if w not in known:
                known[w] = one(w)
        return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of `size` consecutive word hashes; none if there are fewer words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out = mix(out ^ h[i : i + n])
    return out
