"""Names for stretches of a sequence: 64-bit polynomial hashes, any stretch at once."""

from __future__ import annotations

import numpy as np

_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # odd, so that they have inverses
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit number over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number for each byte value.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP[0]))


def _tables(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64."""
    have = _powers.get(which)
    if have is None or len(have[0]) <= size:
        base = _BASES[which]
        inverse = pow(base, -1, 1 << 64)
        n = max(1 << 16, 1 << size.bit_length())
        out = []
        for b in (base, inverse):
            p = np.ones(n, np.uint64)
            p[1] = b
            done = 2
            while done < n:  # the first half times base^half
                step = pow(b, done, 1 << 64)
                p[done : 2 * done] = p[:done] * np.uint64(step)
                done *= 2
            out.append(p)
        have = _powers[which] = (out[0], out[1])
    return have


class Names:
    """Names of stretches [lo, hi) of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray, which: int = 0):
        powers, self.inverse = _tables(which, len(codes))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers[: len(codes)], out=self.sums[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        raw = (self.sums[hi] - self.sums[lo]) * self.inverse[lo]
        return mix(raw + (hi - lo).astype(np.uint64) * np.uint64(_STEP[1]))

    def every(self, size: int) -> np.ndarray:
        """The names of all stretches of one size."""
        n = len(self.sums) - size
        raw = (self.sums[size:] - self.sums[:n]) * self.inverse[:n]
        return mix(raw + np.uint64(size * _STEP[1] % (1 << 64)))


def words_in(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts that lie behind each other in ``data`` (bytes): where they start
    and end, and the bounds of the texts in words."""
    filled = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], filled])
    after = np.concatenate([filled, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, bounds)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Names(BYTE_CODES[data])(starts, ends)
