"""Texts of Arrow batches as flat byte arrays, and hashes of their words, without a loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text taken at a time; temporaries are a small multiple of it.
BLOCK = 1 << 20

_RANDOM = np.random.default_rng(20_261)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: White space of the word rule: blank and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Random bits of each byte, capital letters apart; _VALUES has those of small letters for A-Z.
CASED = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES = CASED.copy()
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_powers: dict[str, np.ndarray] = {}


def bucket(id_col: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def row_blocks(offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most ``most`` bytes together, or one longer row."""
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), rows)
        yield begin, end
        begin = end


def text_blocks(column: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of a column, a block at a time."""
    data, offsets = flat(column)
    for begin, end in row_blocks(offsets, most):
        yield begin, end, data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < size:
        steps = np.full(max(size, BLOCK), base, np.uint64)
        steps[0] = 1
        known = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return known[:size]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its length in bytes, offsets of each text's words)."""
    hashes, starts, ends = word_places(data, offsets)
    return hashes, ends - starts, np.searchsorted(starts, offsets)


def word_places(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its first byte, the byte after its last).

    A word is a longest run of bytes that are not ``space``, A-Z lower-cased.
    """
    inside = ~space[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[first] = inside[first]
    closes = inside.copy()
    closes[:-1] &= opens[1:] | ~inside[1:]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return span_hashes(data, starts, ends), starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """Hashes of spans in rising order, without overlaps: a polynomial over 64 random bits per byte, mixed
    with the length. ``values`` has those bits; by default A-Z are as a-z."""
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # as many words as fit a block, or one longer word
        stop = max(int(np.searchsorted(ends, starts[at] + BLOCK, "right")), at + 1)
        low, high = int(starts[at]), int(ends[stop - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * _power("up", _BASE, high - low), out=sums[1:])
        begin = starts[at:stop] - low
        hashes[at:stop] = (sums[ends[at:stop] - low] - sums[begin]) * _power("down", _INVERSE, high - low)[begin]
        at = stop
    return mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``size`` words, as sorted 64-bit hashes.

    A text with fewer words has its whole sequence as one shingle, one without words none.
    """
    rolled = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k in range(size):
        rolled = mix(rolled + hashes[k : k + len(rolled)] + np.uint64(2 * k + 1))
    found = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - begin >= size:
            found.append(np.unique(rolled[begin : end - size + 1]))
        elif end > begin:
            whole = np.zeros(1, np.uint64)
            for k in range(begin, end):
                whole = mix(whole + hashes[k] + np.uint64(2 * (k - begin) + 1))
            found.append(mix(whole + np.uint64(end - begin)))
        else:
            found.append(rolled[:0])
    return found
