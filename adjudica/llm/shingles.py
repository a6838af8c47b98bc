"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from adjudica.llm.common import M64, mix, word_hashes

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(flat: np.ndarray, ends: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the runs of ``words`` words of every row, A-Z lower-cased.

    A row with fewer words has its whole sequence as the only shingle; one without words has none.
    """
    hashes, _, _, rows = word_hashes(flat, ends, lower=True)
    runs = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for j in range(words):
        runs *= _STEP
        runs += hashes[j : j + len(runs)]
    runs = mix(runs)
    bounds = rows.tolist()
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= words:
            row = np.sort(runs[a : b - words + 1])
            distinct = np.ones(len(row), bool)
            np.not_equal(row[1:], row[:-1], out=distinct[1:])
            yield row[distinct]
        elif b > a:
            short = b - a
            for h in hashes[a:b].tolist():
                short = (short * int(_STEP) + h) & M64
            yield mix(np.array([short], np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        else:
            yield runs[:0]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
