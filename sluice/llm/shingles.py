"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_TURN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each text its distinct shingles, as sorted hashes.

    A-Z count as lower case and words are what stands between the characters 9-13 and 32, which is how ``bytes`` are
    lowered and split. A text with fewer words than ``width`` has its whole sequence as one shingle; one without any
    has none.
    """
    words = [text.lower().split() for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    total = int(lengths.sum())
    each = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, total)
    rolled = np.zeros(max(total - width + 1, 0), np.uint64)
    for j in range(width):
        rolled = rolled * _TURN + each[j : j + len(rolled)]
    rolled = _mixed(rolled)
    out, start = [], 0
    for n in lengths.tolist():
        if n >= width:
            out.append(np.unique(rolled[start : start + n - width + 1]))
        elif n:
            x = np.full(1, n, np.uint64)
            for h in each[start : start + n]:
                x = x * _TURN + h
            out.append(_mixed(x))
        else:
            out.append(np.empty(0, np.uint64))
        start += n
    return out


def set_hash(found: np.ndarray) -> int:
    """A signed 64-bit hash of a set of shingles."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)
