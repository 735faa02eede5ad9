"""Vectorised word and shingle fingerprints of one text (NumPy, 64 bits, no per-word Python)."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15  # any odd number serves as the base of the polynomial
_MASK = (1 << 64) - 1
#: Powers of the base for places inside a word; longer words wrap with a factor of their own.
_WRAP = 4096


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _P, dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


_POW = _powers(_WRAP)
_BLOCK = U(pow(_P, _WRAP, 1 << 64) | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(_P) + U(salt))


def words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after) of each word [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, and the bytes."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    solid = np.zeros(raw.size + 2, np.int8)
    solid[1:-1] = ~_BLANK[raw]
    edge = np.diff(solid)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not starts.size:
        return np.empty(0, U), starts, ends, raw
    lens = ends - starts
    first = np.cumsum(lens) - lens  # of each word among the solid bytes
    solid_bytes = raw[solid[1:-1].view(bool)]
    place = np.arange(solid_bytes.size, dtype=np.int32) - np.repeat(first.astype(np.int32), lens)
    if lens.max() <= _WRAP:
        part = (solid_bytes.astype(U) + U(1)) * _POW[place]
    else:
        part = (solid_bytes.astype(U) + U(1)) * _POW[place % _WRAP] * (U(1) + (place // _WRAP).astype(U) * _BLOCK)
    return mix(np.add.reduceat(part, first) + lens.astype(U)), starts, ends, raw


_GRAM = seeds(8, 0x5851F42D) | U(1)


def shingles(w: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct fingerprints of the ``size``-word shingles; fewer words make one of them all."""
    if not w.size:
        return np.empty(0, U)
    if w.size < size:
        size = w.size
    total = np.full(w.size - size + 1, U(size), dtype=U)
    for i in range(size):
        total += w[i : i + total.size] * _GRAM[i]
    return np.unique(mix(total))
