"""Words and 64-bit hashes of whole batches of texts as numpy arrays."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def letters_and_digits() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` in lower-cased text."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x80:] = True
    return inside


def not_space() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.ones(256, bool)
    inside[0x20] = inside[0x09:0x0E] = False
    return inside


LOWER, ALNUM, DENSE = lower_ascii(), letters_and_digits(), not_space()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        run = np.full(max(n, 1 << 16), base, np.uint64)
        run[0] = 1
        _powers[name] = np.multiply.accumulate(run)
    return _powers[name][:n]


def find(data: np.ndarray, rows: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and row of every run of ``inside`` bytes; runs end at row ends."""
    here = np.zeros(len(data) + 2, bool)
    here[1:-1] = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[rows] = True
    starts = np.flatnonzero(here[1:] & (~here[:-1] | cut))
    ends = np.flatnonzero(here[:-1] & (~here[1:] | cut))
    return starts, ends, np.searchsorted(rows, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of every span, the same wherever the span stands."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(_BASE, "up", n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, "down", n + 1)[starts]
               + (ends - starts).astype(np.uint64))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words; the caller drops those across rows."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, length, np.uint64)
    for j in range(length):
        total += mix(words[j:j + n] + np.uint64(j + 1)) * _PLACE[j % 64]
    return mix(total)


def shingle_sets(data: np.ndarray, rows: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, end to end, and the n + 1 row offsets.

    Lower-cases A-Z; words are runs without white space. A row with fewer than ``size``
    words, but not none, has its whole sequence as one shingle.
    """
    data = LOWER[data]
    starts, ends, row = find(data, rows, DENSE)
    words = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=len(rows) - 1) if len(row) else np.zeros(len(rows) - 1, np.int64)
    parts, owners = [], []
    if len(words) >= size:
        same = row[:len(row) - size + 1] == row[size - 1:]
        parts.append(run_hashes(words, size)[same])
        owners.append(row[:len(row) - size + 1][same])
    first = np.concatenate([[0], np.cumsum(count)])
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            at = first[short][:, None] + np.arange(n)
            total = np.full(len(short), n, np.uint64)
            for j in range(n):
                total += mix(words[at[:, j]] + np.uint64(j + 1)) * _PLACE[j]
            parts.append(mix(total))
            owners.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    value, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows) - 1))])
