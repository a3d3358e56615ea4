"""Words and 64-bit word hashes of many texts at once, in numpy.

A text's words are the maximal runs of bytes that are not separators.  All
separators here are ASCII, and bytes of a multi-byte character are never
ASCII, so splitting UTF-8 bytes equals splitting characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _random64(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(
        1, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTE_VALUES = _random64(256, 11)
_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64),
                                     np.full(4095, MULTIPLIER)]), dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64),
                                             np.full(2 * n, MULTIPLIER)]), dtype=np.uint64)
    return _POWERS


def byte_table(separators: str, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(byte -> byte after lower-casing A-Z, byte -> is it a separator)."""
    to = np.arange(256, dtype=np.uint8)
    if lower:
        to[65:91] += 32
    sep = np.zeros(256, bool)
    sep[np.frombuffer(separators.encode("latin-1"), np.uint8)] = True
    return to, sep[to] if lower else sep


#: Space and the controls 9 to 13.
SPACES = byte_table(" \t\n\x0b\x0c\r")
SPACES_AS_IS = byte_table(" \t\n\x0b\x0c\r", lower=False)
#: All of ASCII but digits and letters.
PUNCTUATION = byte_table("".join(chr(c) for c in range(128)
                                 if not (48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90)))


@dataclass
class Words:
    data: np.ndarray      # bytes after lower-casing
    start: np.ndarray     # first byte of each word
    end: np.ndarray       # one past its last byte
    hash: np.ndarray      # uint64 of its bytes
    row: np.ndarray       # words of text r are start[row[r]:row[r + 1]]

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(data: np.ndarray, offsets: np.ndarray,
          tables: tuple[np.ndarray, np.ndarray] = SPACES, prefix: int | None = None) -> Words:
    """Words of each text.  With ``prefix`` the hash covers that many bytes only."""
    to, sep = tables
    n = len(data)
    data = to[data]
    inside = ~sep[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    start = np.flatnonzero(begins)
    stops = np.zeros(n + 1, bool)
    stops[1:] = inside
    if n:
        stops[1:n] &= ~inside[1:] | first[1:]
    stops[0] = False
    end = np.flatnonzero(stops)
    row = np.searchsorted(start, offsets)
    if not len(start):
        return Words(data, start, end, np.empty(0, np.uint64), row)
    length = end - start
    if prefix is not None:
        length = np.minimum(length, prefix)
    # positions of the word's bytes, flattened
    total = np.concatenate([[0], np.cumsum(length)])
    within = np.arange(total[-1]) - np.repeat(total[:-1], length)
    values = BYTE_VALUES[data[np.repeat(start, length) + within]]
    values *= powers(int(length.max()) + 1)[within]
    hashed = np.add.reduceat(values, total[:-1])
    return Words(data, start, end, mix(hashed ^ (length.astype(np.uint64) * MULTIPLIER)), row)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out + hashes[k:k + n]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return mix(out)
