"""Vectorised word and shingle hashing over UTF-8 bytes.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased; both rules only touch ASCII bytes, so they hold for any UTF-8 text.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(text: str | None, plain: bool = False) -> np.ndarray:
    """One 64-bit hash per word of the whole text, in order.

    ``plain``: all letters are lower-cased first and ASCII punctuation parts words.
    """
    if plain:
        text = (text or "").lower()
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = np.concatenate(([False], ~(_MARKS if plain else _SPACE)[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not edges.size:
        return np.empty(0, dtype=np.uint64)
    starts, ends = edges[0::2], edges[1::2]
    lengths = ends - starts
    kept = np.flatnonzero(inside[1:-1])
    place = np.arange(kept.size, dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place -= np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _ODD, dtype=np.uint64))
    value = _BYTE[_LOWER[raw[kept]]] * power[place]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles.

    A text with fewer words has its whole sequence as one shingle; a text
    without words has none.
    """
    words = word_hashes(text)
    if not words.size:
        return words
    take = min(width, words.size)
    n = words.size - take + 1
    out = np.full(n, np.uint64(take), dtype=np.uint64)
    for k in range(take):
        out = mix(out * _ODD + words[k : k + n])
    return np.unique(out)
