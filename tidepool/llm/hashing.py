"""64-bit hashing of words and of combinations of them, inside Python workers."""

from __future__ import annotations

import numpy as np
import xxhash

#: Different words whose hashes a worker keeps.
KEPT_WORDS = 300_000


def multiple(i: int) -> np.uint64:
    """i golden-ratio steps, modulo 2**64."""
    return np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift, multiply, shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int) -> np.ndarray:
    """n odd multipliers: a sum of hashes times these depends on their order."""
    return mix(np.array([multiple(i) for i in range(1, n + 1)], "uint64")) | np.uint64(1)


class WordHashes(dict):
    """word -> 64-bit hash; keeps the hashes of up to ``KEPT_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), "uint64", len(words))

    def trim(self) -> None:
        """Start anew when full, so that the words kept are recent ones."""
        if len(self) >= KEPT_WORDS:
            self.clear()


#: Masks of the first 0 to 8 bytes of a little-endian 64-bit value.
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], "uint64")
_EACH = multiple(3) | np.uint64(1)


def words_of_texts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts end to end (A-Z lowered, split at ASCII blanks), and the number of each text's.

    A word's length and its bytes, eight at a time, are scrambled in turn; no word becomes a Python object.
    """
    whole = np.frombuffer(b" ".join([b"", *[t or b"" for t in texts], b" " * 8]).lower(), "uint8")
    blank = (whole == ord(" ")) | (whole - np.uint8(9) < 5)   # 9 to 13: tab, line feed, ... (smaller ones wrap around)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, size = edge[::2], edge[1::2] - edge[::2]
    eight = np.ndarray(len(whole) - 7, "<u8", whole, strides=(1,))   # the eight bytes from every place on
    out = mix(size.astype("uint64") * _EACH + (eight[start] & _FIRST[np.minimum(size, 8)]))
    left = np.arange(len(start))
    for at in range(8, int(size.max(initial=0)), 8):
        left = left[size[left] > at]
        out[left] = mix(out[left] * _EACH + (eight[start[left] + at] & _FIRST[np.minimum(size[left] - at, 8)]))
    bounds = 1 + np.r_[0, np.cumsum([len(t or b"") + 1 for t in texts], dtype="int64")]
    return out, np.diff(np.searchsorted(start, bounds))
