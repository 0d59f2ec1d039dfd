"""Static binary fuse filters: about 9 bits a key, one false positive in 256, built by peeling.

A key hashes to one place in each of three neighbouring segments; its fingerprint is the exclusive or
of the bytes there. Keys are peeled off in rounds, all places that hold a single key at once, and the
bytes are set in the reverse order.
"""

from __future__ import annotations

import math
import struct

import numpy as np

HEAD = struct.Struct("<QIII")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3, whose constants are fixed values."""
    h = keys.astype(np.uint64) + np.uint64(seed)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def _places(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    mask = np.uint64(length - 1)
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _marks(h: np.ndarray) -> np.ndarray:
    return ((h ^ h >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of unsigned 64-bit keys; an empty one rejects everything."""
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    if not n:
        return HEAD.pack(0, 0, 0, 0)
    length = min(1 << 18, 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / length) - 2)
    for seed in range(1, 1000):
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (1 << 63) - 1)
        places = _places(h, length, segments)
        size = (segments + 2) * length
        count = np.bincount(places.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # exclusive or of the keys at a place: the key itself where there is one
        for row in places:
            np.bitwise_xor.at(owner, row, np.arange(n))
        rounds, left = [], n
        single = np.flatnonzero(count == 1)
        while len(single):
            key, at = np.unique(owner[single], return_index=True)
            single = single[at]
            rounds.append((key, single))
            left -= len(key)
            touched = places[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.tile(key, 3))
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if left:
            continue
        table, marks = np.zeros(size, np.uint8), _marks(h)
        for key, at in reversed(rounds):
            p = places[:, key]
            table[at] = marks[key] ^ table[p[0]] ^ table[p[1]] ^ table[p[2]] ^ table[at]
        return HEAD.pack(seed, length, segments, n) + table.tobytes()
    raise RuntimeError("no seed gives a filter")


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for one in 256 of the others."""
    seed, length, segments, n = HEAD.unpack(blob[: HEAD.size])
    keys = np.asarray(keys, np.uint64)
    if not n:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(blob, np.uint8, offset=HEAD.size)
    h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (1 << 63) - 1)
    p = _places(h, length, segments)
    return table[p[0]] ^ table[p[1]] ^ table[p[2]] == _marks(h)
