"""Words of a text as hashes, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Space and the control characters from tab to carriage return end a word.
WORD_ENDS = b" \t\n\x0b\x0c\r"
_IS_END = np.zeros(256, dtype=bool)
_IS_END[list(WORD_ENDS)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        grown = np.full(size, _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers in which every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(data: bytes, size: int = _PIECE) -> Iterator[bytes]:
    """Pieces of about a size that end between words, so that long texts need little memory."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + size, n)
        while end < n and data[end] not in WORD_ENDS:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word of UTF-8 text, in order."""
    found = [_piece_hashes(p) for p in pieces(data)]
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def _piece_hashes(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = ~_IS_END[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    letters = codes[inside]
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    weighed = (letters.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(weighed, first) ^ (lengths.astype(np.uint64) << np.uint64(48)))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; of fewer words, one for the whole sequence; of none, none."""
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        size = len(hashes)
    n = len(hashes) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = (total + hashes[k:k + n]) * _BASE
    return mix(total + np.uint64(size))
