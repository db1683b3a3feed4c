"""Words of a batch of texts as 64-bit hashes, worked out over whole byte arrays.

A word is a longest run of ASCII letters, ASCII digits and non-ASCII characters in the lower-cased text.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (the splitmix64 finaliser); a new array."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256)
    is_word = (byte >= 128) | ((byte >= 48) & (byte < 58)) | ((byte >= 97) & (byte < 123))
    return is_word, mix(byte.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes words of batches of texts; keeps the powers of the hash's base."""

    def __init__(self) -> None:
        self.is_word, self.value = _tables()
        self.grow(1 << 18)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word, offset of each text's first word plus the end)."""
        first, last, at, total = self._cut(texts)
        return self._hash(first, last, total), at

    def with_prefixes(self, texts: list[str], lengths: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
        """Hashes of every word and, for each length, of its first so many bytes (of the
        whole word where it is shorter), in one array each; offsets as above."""
        first, last, at, total = self._cut(texts)
        out = [self._hash(first, last, total)]
        for k in lengths:
            out.append(mix(self._hash(first, np.minimum(first + k, last), total) + np.uint64(k)))
        return out, at

    def _hash(self, first: np.ndarray, last: np.ndarray, total: np.ndarray) -> np.ndarray:
        return mix((total[last] - total[first]) * self.down[first] + (last - first).astype(np.uint64))

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """First and last byte of the words, offsets of the texts' words, and running sums."""
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1)
        data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        if len(data) > len(self.up):
            self.grow(len(data))
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = self.is_word[data]
        step = np.diff(inside)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.value[data] * self.up[: len(data)], out=total[1:])
        return first, last, np.concatenate(([0], np.searchsorted(first, ends))), total


def chunks(texts: list[str], most_chars: int = 200_000):
    """(from, to) ranges of consecutive texts with about that many characters, one text
    at least: what one pass of array work takes at a time."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most_chars:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of `n` words; of all the words where there are fewer."""
    if len(words) == 0:
        return words
    n_here = min(n, len(words))
    out = np.zeros(len(words) - n_here + 1, dtype=np.uint64)
    for j in range(n_here):
        out += words[j: len(words) - n_here + 1 + j] * np.uint64((2 * j + 3) * 0x9E3779B97F4A7C15 % (1 << 64) | 1)
    return mix(out + np.uint64(n_here))
