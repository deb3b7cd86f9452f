"""Content-defined sampling of suffix positions, vectorised over bytes.

A window of ``span`` bytes selects the position of the smallest hash among the
``gram``-byte strings inside it (leftmost on ties).  The choice depends on the
window's bytes alone, so equal windows select the same relative position
wherever they stand: suffixes at selected positions find every repeated window.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


#: A random value for each byte.
BYTE = mix(np.arange(256, dtype=_U) + _U(0x51ED27))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), _U)
    size = 1
    while size < n:
        step = _U(pow(base, size, 2**64))
        m = min(size, n - size)
        out[size : size + m] = out[:m] * step
        size += m
    return out


_cache: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _cache or len(_cache[base]) < n:
        _cache[base] = powers(base, max(n, 1 << 16))
    return _cache[base][:n]


def prefix(data: np.ndarray) -> np.ndarray:
    """Sums from which ``of_slices`` gets the hash of any slice."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE[data] * _power(BASE, len(data)), out=out[1:])
    return out


def of_slices(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same for equal bytes at any place."""
    return mix((sums[end] - sums[start]) * _power(BASE_INVERSE, len(sums))[start] + (end - start).astype(_U))


def rolling(sums: np.ndarray, width: int) -> np.ndarray:
    n = max(len(sums) - width, 0)
    return mix((sums[width : width + n] - sums[:n]) * _power(BASE_INVERSE, len(sums))[:n])


def leftmost_min(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of every ``width`` consecutive values, leftmost on ties, by doubling."""
    at = np.arange(len(x), dtype=np.int32)
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = x[: len(x) - step], x[step:]
        better = right < left
        at = np.where(better, at[step:], at[: len(at) - step])
        x = np.where(better, right, left)
        size += step
    return at


def runs(data: np.ndarray, ends: np.ndarray, span: int, gram: int):
    """(position, first window, last window, gram hash, slice sums) of the suffixes that windows select.

    data holds several documents, which end at ``ends``; no window crosses an end.
    The windows that select a position are consecutive.
    """
    n = len(data) - span + 1
    sums = prefix(data)
    if n <= 0:
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, _U), sums
    h = rolling(sums, gram)
    at = leftmost_min(h, span - gram + 1)[:n].astype(np.int64)
    bad = np.zeros(n + 1, np.int32)
    cut = ends[ends < len(data)]
    np.add.at(bad, np.maximum(cut - span + 1, 0), 1)
    np.add.at(bad, np.minimum(cut, n), -1)
    good = np.cumsum(bad[:-1]) == 0
    code = np.where(good, at, -1)
    new = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    last = np.append(new[1:], n) - 1
    keep = code[new] >= 0
    a, b = new[keep], last[keep]
    p = code[a]
    return p, a, b, h[p], sums
