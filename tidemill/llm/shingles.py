"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from tidemill.llm.hashing import mixed, range_hashes

WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# One odd factor per place in a shingle.
FACTORS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; a text of fewer words is one shingle, one of none has none."""
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    word = ~WHITE[data]
    edge = np.diff(np.concatenate([[0], word.view(np.int8)]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = range_hashes(data, first, last)
    upto = np.searchsorted(first, ends)  # words up to the end of each text
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for j in range(size):
        rolled += h[j : j + len(rolled)] * FACTORS[j]
    rolled = mixed(rolled)
    out, lo = [], 0
    for hi in upto.tolist():
        n = hi - lo
        if n >= size:
            out.append(np.unique(rolled[lo : hi - size + 1]))
        elif n:
            short = (h[lo:hi] * FACTORS[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mixed(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        lo = hi
    return out
