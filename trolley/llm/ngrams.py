"""Hashed byte n-grams of many texts at once."""

from __future__ import annotations

import numpy as np

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_KEEP = np.zeros(256, bool)
_KEEP[48:58] = _KEEP[97:123] = _KEEP[128:] = True
_FOLD[~_KEEP[_FOLD]] = 32
FOLD = _FOLD  # lower-case ASCII letters, digits and bytes of other scripts; everything else is a space
LETTERS = np.where(np.arange(256) < 128, np.where((_FOLD >= 97) & (_FOLD <= 122), _FOLD, 32), np.arange(256)).astype(np.uint8)

_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


def ngram_hashes(data: np.ndarray, ends: np.ndarray, orders: tuple[int, ...], bits: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """order -> (bins, document numbers) of all n-grams inside one document."""
    out, doc = {}, np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
    rolled = data.astype(np.uint32) + np.uint32(1)
    base = rolled
    for n in range(2, max(orders) + 1):
        if len(data) < n:
            rolled = rolled[:0]
        else:
            rolled = (rolled[:len(data) - n + 1] * _STEP) ^ base[n - 1:]
        if n in orders:
            inside = doc[:len(rolled)] == doc[n - 1:n - 1 + len(rolled)]
            bins = ((rolled * _SPREAD) ^ (rolled >> np.uint32(15))) * _STEP >> np.uint32(32 - bits)
            out[n] = (bins[inside], doc[:len(rolled)][inside])
    return out
