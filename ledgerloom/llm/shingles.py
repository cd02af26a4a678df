"""Sets of word shingles as sorted 64-bit hashes, computed for a batch of texts at a time.

Words are split at ASCII white space after A-Z are lower-cased. A word's hash is a polynomial of its bytes
modulo 2**64, mixed; a shingle's hash chains those of its words. Two different shingles share a hash
with probability 2**-64, which is taken as never.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LENGTH = _U(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, _U(base % 2**64))
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data) + 1)[:-1], out=sums[1:])
    # Dividing by the power at the start makes the hash independent of the place.
    shift = _powers(pow(_BASE, -1, 2**64), len(data) + 1)[starts]
    return mix((sums[ends] - sums[starts]) * shift + sizes.astype(np.uint64) * _LENGTH)


def shingle_sets(texts: Sequence[str | None], width: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``width`` words, sorted; with fewer words, all of them as one."""
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = word_hashes([w for words in split for w in words])
    sets, at = [], 0
    for words in split:
        hashes = flat[at : at + len(words)]
        at += len(words)
        size = min(width, len(words))
        if not size:
            sets.append(hashes)
            continue
        count = len(words) - size + 1
        chained = hashes[:count].copy()
        for k in range(1, size):
            chained = mix(chained * _U(_BASE) + hashes[k : k + count])
        sets.append(np.unique(chained))
    return sets
