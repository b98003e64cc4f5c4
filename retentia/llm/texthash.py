"""Vectorised hashing of the words and bytes of many texts at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 20  # bytes hashed at once; bounds the memory whatever the length of a text
BASE = U(0x9E3779B97F4A7C15 | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    steps = np.full(n, base, U)
    steps[:1] = 1
    return np.cumprod(steps, dtype=U)


def inverse(base: np.uint64) -> np.uint64:
    return U(pow(int(base), -1, 1 << 64))


def byte_codes(seed: int, fold_case: bool = False) -> np.ndarray:
    """A random 64-bit number per byte value; with ``fold_case``, A-Z have those of a-z."""
    codes = mixed(np.arange(256, dtype=U) + U(1 + (seed << 16)))
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes in one array, and the start of each text (with the end of the last); null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class WordHasher:
    """64-bit hashes of the words between ASCII white space, A-Z folded to a-z."""

    def __init__(self, seed: int = 1) -> None:
        self.codes = byte_codes(seed, fold_case=True)
        self.powers = powers(BASE, PIECE + 1)
        self.inverses = powers(inverse(BASE), PIECE + 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word, place of each text's first word in it, with the end of the last)."""
        hashes, places, at = [], [], 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            while end < len(data) and not SPACE[data[end]]:  # up to the end of a word
                ahead = np.flatnonzero(SPACE[data[end : end + PIECE]])
                end = end + int(ahead[0]) if len(ahead) else min(len(data), end + PIECE)
            h, p = self._piece(data[at:end], starts[(starts > at) & (starts < end)] - at)
            hashes.append(h)
            places.append(p + at)
            at = end
        word = np.concatenate(hashes) if hashes else np.zeros(0, U)
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        return word, np.searchsorted(place, starts, "left")

    def _piece(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n + 1 > len(self.powers):
            self.powers, self.inverses = powers(BASE, n + 1), powers(inverse(BASE), n + 1)
        inside = ~SPACE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[cuts] |= inside[cuts]  # a text's first byte never continues the text before
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        ends[cuts - 1] |= inside[cuts - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(n + 1, U)
        np.cumsum(self.codes[data] * self.powers[:n], out=sums[1:])
        raw = (sums[last] - sums[first]) * self.inverses[first]
        return mixed(raw + (last - first).astype(U) * U(0xD6E8FEB86659FD93)), first


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for j, c in enumerate(mixed(np.arange(1, k + 1, dtype=U)) | U(1)):
        out += words[j : j + n] * c
    return mixed(out)


def slices(starts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, one text at least."""
    at = 0
    while at < len(starts) - 1:
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
        yield at, end
        at = end
