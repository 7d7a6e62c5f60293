"""Vectorised byte-level helpers over Arrow batches: chunks of whole texts, word spans, polynomial hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
#: Odd multiplier of the polynomial hash modulo 2^64, and its inverse.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A second polynomial hash, modulo a prime: modulo 2^64 alone some different texts of two letters (Thue-Morse words) are alike for any multiplier.
PRIME = (1 << 31) - 1
PRIME_BASE = 1_532_084_327

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i up to n; tables for usual sizes are kept."""
    size = 1 << max(16, int(n).bit_length())
    if size in _powers:
        return _powers[size]
    made = []
    for base in (BASE, INVERSE):
        steps = np.full(size + 1, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    if size <= CHUNK * 2:
        _powers[size] = tuple(made)
    return tuple(made)


_prime_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of PRIME_BASE and of its inverse modulo PRIME, up to n; tables for usual sizes are kept."""
    size = 1 << max(16, int(n).bit_length())
    if size in _prime_powers:
        return _prime_powers[size]
    made = []
    for base in (PRIME_BASE, pow(PRIME_BASE, -1, PRIME)):
        table, known = np.ones(size + 1, np.uint64), 1
        while known <= size:
            many = min(known, size + 1 - known)
            table[known : known + many] = table[:many] * np.uint64(pow(base, known, PRIME)) % np.uint64(PRIME)
            known += many
        made.append(table)
    if size <= CHUNK * 2:
        _prime_powers[size] = tuple(made)
    return tuple(made)


def _fold_prime(x: np.ndarray) -> np.ndarray:
    """A smaller number that is the same modulo PRIME."""
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """Hashes of any byte spans of one buffer, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.inverse = powers(n + 1)
        letters = data.astype(np.uint64) + np.uint64(1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(letters * power[:n], out=self.prefix[1:])
        prime_power, self.prime_inverse = prime_powers(n + 1)
        letters *= prime_power[:n]
        if n >= 1 << 24:  # sums of more terms would need terms below 2^32
            letters = _fold_prime(letters)
        self.prime_prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(letters, out=self.prime_prefix[1:])

    def quick(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash modulo 2^64 alone: for where a few different spans may be alike."""
        raw = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Both hashes in one: spans are alike only where both are."""
        prime = _fold_prime(_fold_prime(self.prime_prefix[end] - self.prime_prefix[start])) * self.prime_inverse[start]
        prime = _fold_prime(_fold_prime(prime)) % np.uint64(PRIME)
        return mix(self.quick(start, end) + prime * np.uint64(0xA0761D6478BD642F))


def texts_of(column: pa.Array) -> pa.Array:
    """Null texts as empty ones, 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past last row, bytes, offsets from 0) for runs of whole texts of about ``limit`` bytes; a longer text is a run alone."""
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        high = min(high, n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def span_bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that don't cross a text's border."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The text that each byte position is in."""
    return np.searchsorted(offsets[1:], positions, side="right")


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more; has it occurred before."""
    any_two, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        earlier[order[1:]] = same
        any_two[order[1:]] = same
        any_two[order[:-1]] |= same
    return any_two, earlier
