"""Words of whole Arrow batches as 64-bit hashes, without a Python loop over words.

A word is a longest run of bytes outside ``[\\x20\\x09-\\x0D]``; in UTF-8 those
bytes never occur inside a longer character. A word's hash is two polynomials in its
bytes, modulo two primes below 2**31 (prefix sums give all words at once), mixed with its
length: modulo a power of two, long regular words would clash whatever the base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Multiplier of runs of word hashes.
_BASE = 0x9E3779B97F4A7C55
#: The largest primes below 2**31, each with a base of its own for the bytes of a word.
_FIELDS = ((2147483647, 1103515249), (2147483629, 1566083947))
#: Bytes whose unreduced terms, below 2**39 each, still sum without overflow.
_UNREDUCED = 1 << 24
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Also apart at ASCII punctuation and control characters: runs of letters, digits and all non-ASCII characters.
_NO_WORD = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[tuple[int, int], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a one-to-one map)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(base: int, prime: int, n: int) -> np.ndarray:
    """The powers of ``base`` modulo ``prime``, n of them or more."""
    have = _powers.get((base, prime))
    if have is None or len(have) < n:
        have = np.ones(1, U)
        while len(have) < max(n, 1 << 19):
            have = np.concatenate((have, have * U(pow(base, len(have), prime)) % U(prime)))
        _powers[base, prime] = have
    return have


def _residues(data: np.ndarray, start: np.ndarray, end: np.ndarray, prime: int, base: int) -> np.ndarray:
    """The polynomial of the bytes of each stretch modulo ``prime``."""
    n, p = len(data), U(prime)
    sums = np.zeros(n + 1, U)
    terms = sums[1:]
    terms[:] = data
    terms += U(1)
    terms *= _power(base, prime, n)[:n]
    if n > _UNREDUCED:
        terms %= p
    np.cumsum(terms, out=terms)
    # Powers come down with the place, so that equal words have equal values wherever they stand.
    return (sums[end] - sums[start]) % p * _power(pow(base, -1, prime), prime, n)[start] % p


class Words:
    """The words of some rows: ``hashes``, ``offsets`` of each row's first word, and byte places."""

    def __init__(self, data: np.ndarray, row_bytes: np.ndarray, lower: bool, letters: bool = False):
        """data: the rows' bytes in one array; row_bytes: len(rows)+1 places where rows begin; letters: punctuation separates too."""
        n = len(data)
        self.data = data = _LOWER[data] if lower else data
        self.rows = len(row_bytes) - 1
        if not n:
            self.hashes, self.start, self.end = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.offsets = np.zeros(self.rows + 1, np.int64)
            return
        solid = ~(_NO_WORD if letters else _SPACE)[data]
        cut = np.zeros(n + 1, bool)
        cut[row_bytes] = True
        first = solid.copy()
        first[1:] &= ~solid[:-1] | cut[1:n]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | cut[1:n]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        low, high = (_residues(data, self.start, self.end, prime, base) for prime, base in _FIELDS)
        length = (self.end - self.start).astype(U)
        self.hashes = mix((high << U(31) | low) + length * U(0xD6E8FEB86659FD93))
        self.offsets = np.searchsorted(self.start, row_bytes)

    @property
    def counts(self) -> np.ndarray:
        """Words of each row."""
        return np.diff(self.offsets)

    def row_of(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.rows), self.counts)

    def text(self, i: int) -> bytes:
        """The bytes of word i."""
        return self.data[self.start[i] : self.end[i]].tobytes()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the places where rows begin."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, lower: bool, size: int = 1 << 19, letters: bool = False) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of a batch with about ``size`` bytes of text each (one row at least), with their words."""
    data, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield batch.slice(i, j - i), Words(data[at[i] : at[j]], at[i : j + 1] - at[i], lower, letters)
        i = j


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k consecutive word hashes, row borders ignored: len(hashes)-k+1 values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    acc = hashes[:n].copy()
    for i in range(1, k):
        acc *= U(_BASE)
        acc += hashes[i : i + n]
    return mix(acc ^ U((k * 0xA0761D6478BD642F) & ((1 << 64) - 1)))


def run_starts(words: Words, k: int) -> np.ndarray:
    """Places among all words where k words of one row begin."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    left = np.repeat(words.offsets[1:], words.counts)[:n] - np.arange(n)
    return np.flatnonzero(left >= k)


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Each row's sorted distinct k-word shingles; with fewer words the whole sequence as one; without words none."""
    every = runs(words.hashes, k)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            out.append(runs(words.hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, U))
    return out
