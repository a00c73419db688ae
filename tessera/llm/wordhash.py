"""Hashes of words and of word windows as numpy arrays (no Python object per word)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 19  # bytes hashed at once: bounds memory whatever the length of a text

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = np.random.default_rng(20240229)
_BYTE = _R.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_BASE = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
_INVERSE = [np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASE]


class _Powers:
    """Powers of an odd base modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            t = np.full(max(n, 2 * len(self.table)), self.base, np.uint64)
            t[0] = 1
            self.table = np.multiply.accumulate(t)
        return self.table[:n]


_IN_WORD = _Powers(np.uint64(0xA0761D6478BD642F))
_UP = [_Powers(b) for b in _BASE]
_DOWN = [_Powers(b) for b in _INVERSE]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_bytes(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the offset of each word's first byte."""
    b = np.frombuffer(data, np.uint8)
    white = _SPACE[b]
    first = ~white
    first[1:] &= white[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    spans = np.diff(np.append(starts, len(b)))
    b, white = b[starts[0] :], white[starts[0] :]
    place = np.arange(len(b)) - np.repeat(starts - starts[0], spans)
    v = (_LOWER if lower else _BYTE)[b] * _IN_WORD.upto(int(spans.max()))[place]
    v[white] = 0
    return mix(np.add.reduceat(v, starts - starts[0])), starts


def word_hashes(texts: list[str], lower: bool = False) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order. Short texts share a numpy pass, a long one takes several."""
    group: list[bytes] = []
    size = 0

    def flush():
        data = b"\n".join(group)
        h, starts = _hash_bytes(data, lower)
        ends = np.cumsum([len(g) + 1 for g in group])
        yield from np.split(h, np.searchsorted(starts, ends[:-1]))

    for t in texts:
        data = t.encode()
        if group and size + len(data) > CHUNK:
            yield from flush()
            group, size = [], 0
        if len(data) > CHUNK:
            parts, a = [], 0
            while a < len(data):
                e = min(a + CHUNK, len(data))
                while e < len(data) and not _SPACE[data[e]]:
                    e += 1
                parts.append(_hash_bytes(data[a:e], lower)[0])
                a = e
            yield np.concatenate(parts)
            continue
        group.append(data)
        size += len(data)
    if group:
        yield from flush()


def window_hashes(words: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp hashes of every window of ``n`` words: a difference of prefix sums of
    ``word * base^i``, moved back to ``base^0``. ``which`` picks one of two independent bases."""
    k = len(words) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    w = mix(words + np.uint64(0x632BE59BD9B4E019)) if which else words
    sums = np.zeros(len(w) + 1, np.uint64)
    np.cumsum(w * _UP[which].upto(len(w)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * _DOWN[which].upto(k))
