"""Word shingles of whole texts as sorted sets of 64-bit hashes, for many documents at once."""

from __future__ import annotations

import numpy as np

_SEED = 20_011
_CHUNK = 1 << 16  # bytes of words hashed at once (one longer word alone)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = _BYTE[_LOWER]
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.cumprod(np.full(_CHUNK, _ODD, np.uint64))  # from the first power on
_INVERSE = np.cumprod(np.append(np.uint64(1), np.full(_CHUNK, np.uint64(pow(int(_ODD), -1, 1 << 64)))))  # from the zeroth on


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+; a document's end also ends its word."""
    ink = np.zeros(len(data) + 2, bool)
    np.greater(data - np.uint8(9), 4, out=ink[1:-1])  # not 9 to 13
    ink[1:-1] &= data != 32
    change = np.flatnonzero(ink[1:] != ink[:-1])
    starts, stops = change[::2], change[1::2]
    cut = np.unique(ends)
    cut = cut[ink[cut] & ink[cut + 1]]  # between two letters
    if len(cut):
        starts, stops = (np.insert(x, np.searchsorted(x, cut), cut) for x in (starts, stops))
    return starts, stops


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word of its bytes with A-Z in lower case: a polynomial modulo 2^64, from running
    sums whose powers count from the chunk's start and are divided out at the word's."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + _CHUNK, "right")))
        begins, ends = starts[at:to] - starts[at], stops[at:to] - starts[at]
        taken = _FOLDED[data[starts[at]:stops[to - 1]]]
        taken *= _POWER[:len(taken)] if len(taken) <= _CHUNK else np.cumprod(np.full(len(taken), _ODD, np.uint64))
        running = np.zeros(len(taken) + 1, np.uint64)
        np.cumsum(taken, out=running[1:])
        out[at:to] = mix((running[ends] - running[begins]) * _INVERSE[begins] + (ends - begins).astype(np.uint64))
        at = to
    return out


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sets, bounds): document i's sorted distinct shingles are ``sets[bounds[i]:bounds[i + 1]]``.

    A document of fewer than ``width`` words has its whole sequence as one shingle; one without
    words has none.
    """
    n_docs = len(ends) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    starts, stops = words(data, ends)
    hashes = word_hashes(data, starts, stops)
    by_doc = np.searchsorted(starts, ends)  # word bounds of each document
    bounds, found = np.zeros(n_docs + 1, np.int64), []
    for i in range(n_docs):
        own = hashes[by_doc[i]:by_doc[i + 1]]
        if len(own):
            k = min(width, len(own))
            value = np.full(len(own) - k + 1, k, np.uint64)
            for j in range(k):
                value = mix(value * _ODD + own[j:len(own) - k + 1 + j])
            own = np.unique(value)
            found.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), bounds
