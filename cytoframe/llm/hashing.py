"""Vectorised word splitting and 64-bit hashing over packed text bytes.

Short spans are hashed by a polynomial modulo 2**64 from one prefix sum. Two structured words of 1,024 symbols or more can agree under
every such polynomial (Thue-Morse words do), so spans of over EXACT symbols take a cryptographic digest of their symbols instead.
"""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
EXACT = 400
KEPT_POWERS = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; up to KEPT_POWERS of them are kept."""
    have = _powers.get(base, np.ones(1, U64))
    while len(have) < n:
        have = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
    if len(have) <= KEPT_POWERS:
        _powers[base] = have
    return have[:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, pow(_BASE, -1, 1 << 64))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each span; equal content gives equal hashes."""
    n = len(values)
    total = np.zeros(n + 1, U64)
    np.cumsum(values * powers(n), out=total[1:])
    h = (total[ends] - total[starts]) * inverse_powers(n + 1)[starts]
    h = mix(h ^ ((ends - starts).astype(U64) << U64(48)))
    long = np.flatnonzero(ends - starts > EXACT)
    if len(long):
        h[long] = [int.from_bytes(hashlib.blake2b(values[a:b].tobytes(), digest_size=8).digest(), "little") for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, *, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and how many words each text has.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, or with `letters` runs of ASCII letters, digits and bytes from 0x80 on.
    """
    n = len(data)
    inside = _LETTERS[data] if letters else ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    begins = inside & first[:n]
    begins[1:] |= inside[1:] & ~inside[:-1]
    if n:
        begins[0] = inside[0]
    finish = np.zeros(n, bool)
    if n:
        finish[:-1] = inside[:-1] & (~inside[1:] | first[1:n])
        finish[-1] = inside[-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finish) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, offsets: np.ndarray, *, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ASCII-lower-cased words, their starts and ends, and the word count of each text."""
    starts, ends, counts = words(data, offsets, letters=letters)
    return span_hashes(BYTE[LOWER[data]], starts, ends), starts, ends, counts


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `width` consecutive words within each text; a text of fewer words gives its whole sequence as one, one without words none."""
    begin = np.cumsum(counts) - counts
    number = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    at = np.repeat(begin, number) + (np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number))
    to = np.minimum(at + width, np.repeat(begin + counts, number))
    return span_hashes(hashes, at, to), number
