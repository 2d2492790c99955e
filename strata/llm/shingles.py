"""Word shingles as sorted arrays of 64-bit hashes, and whole-batch numpy work on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U = np.uint64
_ODD = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                       0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (xor-shift and multiply)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """word bytes -> 64-bit hash; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 300_000:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U, len(words))


def sequence(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words in order; of fewer words, one of them all."""
    n = len(hashes)
    if not n:
        return hashes
    if n < k:
        k = n
    out = np.full(n - k + 1, U(k), U)
    for j in range(k):
        out = out * _ODD[7] + hashes[j:n - k + 1 + j] * _ODD[j % 7]
    return mix(out)


def fingerprint(shingle_set: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed longs."""
    d = xxhash.xxh3_128_digest(shingle_set.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def in_groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to about ``limit`` at most."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def dealt(groups: int, *columns: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows dealt by a hash of the columns: each group that has some, and their places."""
    h = np.zeros(len(columns[0]), U)
    for c in columns:
        h = mix(h + c.astype(U) + U(0x9E3779B97F4A7C15))
    group = ((h >> U(32)) * U(groups) >> U(32)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    for x in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if len(x):
            yield int(group[x[0]]), x
