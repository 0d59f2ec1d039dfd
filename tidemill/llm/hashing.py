"""64-bit hashes of many byte ranges at once."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be undone modulo 2**64
LEAST = 1 << 20

_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one (the constants of MurmurHash3, fixed values)."""
    h = h ^ h >> np.uint64(33)
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end] of bytes: a polynomial in BASE, from differences of prefix sums."""
    if not _POWERS or len(_POWERS[0][0]) <= len(data):
        _POWERS[:] = [_powers(max(len(data) + 1, LEAST))]
    up, down = _POWERS[0]
    if len(up) > 4 * LEAST:  # those of a very long text are not kept
        _POWERS.clear()
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start])
