"""Words of whole Arrow batches as numpy arrays: where they lie, and 64-bit hashes of them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from cohorta.llm.common import WHITE

_RATE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2^64
_LETTERS = np.random.default_rng(20240229).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

#: Text hashed at once: the tables of powers and the running sums take some hundred bytes per byte of it.
HASH_BYTES = 1 << 18
#: Letters of a word, or hashes of its pieces, under one polynomial. Modulo 2^64 some long sequences collide whatever the
#: letters' values (Thue-Morse words of 1,024 letters); within so few letters those still differ in 40 bits and more.
PIECE = 32

#: Bytes with A-Z made small; other bytes are kept.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Which bytes are part of a word: all but white space.
NOT_WHITE = ~np.isin(np.arange(256), [ord(c) for c in WHITE])
#: Letters, digits and all bytes of multi-byte characters, once A-Z are small.
LETTERS = np.array([48 <= b < 58 or 97 <= b < 123 or b >= 128 for b in range(256)])


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array without nulls, end to end, and the n + 1 places where texts begin and end."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1 + raw.offset)[raw.offset:]
    data = raw.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def word_spans(flat: np.ndarray, offsets: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first): the runs of bytes in `within`, cut at text borders, and the number of the first run of
    each text (n + 1 entries)."""
    if not len(flat):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = within[flat]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]
    begins[edge] = inside[edge]
    edge = offsets[1:][np.diff(offsets) > 0] - 1
    ends[edge] = inside[edge]
    begin = np.flatnonzero(begins)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets)


@lru_cache(maxsize=2)  # of letters, and of the pieces of long words
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rate = np.full(n + 1, _RATE, np.uint64)
    back = np.full(n + 1, pow(_RATE, -1, 1 << 64), np.uint64)
    rate[0] = back[0] = 1
    return np.cumprod(rate, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rate and of its inverse, up to n at least; tables of the last sizes are kept."""
    return _powers(1 << max(n, 1 << 16).bit_length())


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running sums of values times powers; span_hash turns two of them into the hash of what lies between."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][:len(values)], out=total[1:])
    return total


def span_hash(total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    back = powers(len(total))[1]
    return mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))


def hash_words(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans hash alike wherever they lie."""
    return _hash_spans(_LETTERS[flat], begin, end)


def _hash_spans(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans of up to PIECE values by their polynomial, longer ones as the span of the hashes of their pieces."""
    total = prefix_hashes(values)
    out = span_hash(total, begin, np.minimum(end, begin + PIECE))
    long = np.flatnonzero(end - begin > PIECE)
    if len(long):
        pieces = -(-(end[long] - begin[long]) // PIECE)
        stop = np.cumsum(pieces)
        nth = np.arange(stop[-1]) - np.repeat(stop - pieces, pieces)
        at = np.repeat(begin[long], pieces) + nth * PIECE
        hashes = span_hash(total, at, np.minimum(at + PIECE, np.repeat(end[long], pieces)))
        out[long] = _hash_spans(hashes, stop - pieces, stop)
    return out


def hash_runs(items: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` neighbouring items (hashes of words): len(items) - size + 1 of them."""
    n = len(items) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, seed = np.zeros(n, np.uint64), np.uint64(size)
    for k in range(size):
        total = total * np.uint64(_RATE) + items[k:k + n]
    return mix(total + seed)
