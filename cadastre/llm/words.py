"""Words of many texts at a time: positions and 63-bit hashes, as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\x0b\x0c\r"

_RNG = np.random.default_rng(20240229)
_BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_FACTORS = _RNG.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: bytes that are part of a word: everything but the six ASCII spaces
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
#: ASCII letters and every byte of a character beyond ASCII
LETTERS = np.zeros(256, bool)
for _a, _b in ((65, 91), (97, 123), (128, 256)):
    LETTERS[_a:_b] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or places[-1] == places[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0]:places[-1]], places - places[0]


def find_words(data: np.ndarray, offsets: np.ndarray,
               inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of ``inside`` bytes, and the first word of each text.

    The third array has one entry more than there are texts.
    """
    word = inside[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               step: int = 1 << 18) -> np.ndarray:
    """64-bit hash of each word after lower-casing A-Z."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), step):
        out[i:i + step] = _hash_some(data, starts[i:i + step], ends[i:i + step])
    return out


def _hash_some(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    first = np.zeros(len(sizes), np.int64)
    np.cumsum(sizes[:-1], out=first[1:])
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.ones(int(sizes.max()), np.uint64)
    powers[1:] = _BASE
    powers = np.multiply.accumulate(powers)
    values = _BYTE_CODES[LOWER[data[place + np.repeat(starts, sizes)]]] * powers[place]
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64))


def hash_shingles(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of all runs of ``size`` words within each text, and each text's first one.

    A text with fewer words, but at least one, has one shingle: all its words.
    """
    counts = np.diff(firsts)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    if not len(words):
        return np.zeros(0, np.uint64), bounds
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], made) + np.repeat(firsts[:-1], made)
    last = np.repeat(firsts[1:], made)
    total = np.zeros(len(at), np.uint64)
    used = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = at + k < last
        total += np.where(there, words[np.minimum(at + k, len(words) - 1)] * _SHINGLE_FACTORS[k], 0)
        used += there
    return mix(total + used) >> np.uint64(1), bounds
