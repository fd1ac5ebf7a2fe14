"""64-bit hashes of words, shingles and substrings, vectorised over a text's bytes.

A text is a polynomial in one odd base modulo 2**64 over a random value per
byte; differences of its prefix sums, divided by a power of the base, give the
hash of any substring without a loop. All constants are derived from one seed,
so every worker computes the same hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
_CHUNK = 1 << 20
_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; kept and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 4096, 0 if have is None else 2 * len(have))
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SYMBOLS = 1 << 11
_symbol = mix(np.arange(1, _SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)


def symbol_values(points: np.ndarray) -> np.ndarray:
    """An odd random number for each code point; the frequent low ones come from a table."""
    if len(points) and points.max() >= _SYMBOLS:
        return mix(points.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    return _symbol[points]


class Substrings:
    """Hashes of the substrings of one string of bytes, or of ``values``: a random number per symbol."""

    def __init__(self, data: np.ndarray, values: bool = False):
        terms = (data if values else _BYTE[data]) * _power(_BASE, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * _power(_INVERSE, len(self.sums))[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def _blocks(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of about ``_CHUNK`` bytes, cut at white space."""
    at = 0
    while len(data) - at > 2 * _CHUNK:
        gap = np.flatnonzero(_SPACE[data[at + _CHUNK:at + 2 * _CHUNK]])
        if not len(gap):
            break
        yield data[at:at + _CHUNK + gap[0]]
        at += _CHUNK + int(gap[0])
    yield data[at:]


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words (runs without white space) of a whole text, A-Z in lower case."""
    data = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    out = []
    for part in _blocks(data):
        inside = np.zeros(len(part) + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[part]
        edge = np.diff(inside)
        out.append(Substrings(part).hashes(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
    return np.concatenate(out) if len(out) > 1 else out[0]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; fewer words count as one shingle, none give none."""
    if not text:
        return np.empty(0, np.uint64)
    w = word_hashes(text)
    if not len(w):
        return np.empty(0, np.uint64)
    size = min(SHINGLE, len(w))
    total = np.full(len(w) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total += w[k:len(w) - size + 1 + k] * _PLACE[k]
    return np.unique(mix(total))


def set_key(hashes: np.ndarray) -> int:
    """A signed 64-bit key of a set of hashes: equal sets have equal keys."""
    total = int(np.sum(mix(hashes + np.uint64(1)), dtype=np.uint64))
    return int(np.uint64(total ^ len(hashes)).astype(np.int64))
