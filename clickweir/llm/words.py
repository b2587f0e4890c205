"""Words of a text column as 64-bit hashes, a whole Arrow batch at a time.

A word is a run of bytes that are not separators, taken after lower-casing A-Z. Its hash
is a polynomial over random byte values modulo 2^64, so that all words of a batch come
from one running sum; equal words have equal hashes, and different ones collide with
probability about 2^-64.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

BLOCK_BYTES = 1 << 20
PORTION_BYTES = 2 << 20

_random = np.random.Generator(np.random.PCG64(20240501))
_BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E6C63D0876A9A47  # odd, so it has an inverse modulo 2^64
_GRAM = _random.integers(1, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values separate words; ranges include both ends."""
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


SPACE = separators((0x20, 0x20), (0x09, 0x0D))
NOT_ALPHANUMERIC = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

# letters take the value of their lower-case form
_LOWERED = _BYTE_VALUES.copy()
_LOWERED[0x41:0x5B] = _BYTE_VALUES[0x61:0x7B]


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, dtype=np.uint64)
    filled = 1
    while filled < count:
        step = np.uint64(pow(base, filled, 1 << 64))
        more = min(filled, count - filled)
        out[filled : filled + more] = out[:more] * step
        filled += more
    return out


_tables: dict[str, np.ndarray] = {}


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < count:
        size = max(count, BLOCK_BYTES * 2)
        _tables["up"] = _powers(_BASE, size)
        _tables["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _tables["up"], _tables["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    out = values ^ (values >> np.uint64(31))
    out = out * np.uint64(0x7FB5D329728EA185)
    out ^= out >> np.uint64(27)
    out = out * np.uint64(0x81DADEF4BC2DD44D)
    out ^= out >> np.uint64(33)
    return out


def release() -> None:
    """Give free memory back, so that a worker that waits for its next task holds none."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # a C library without it


def portions(
    batches: Iterator[pa.RecordBatch], text: int = 1, most: int = PORTION_BYTES
) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most so many bytes of text, or one row, to bound the memory."""
    for batch in batches:
        column = batch.column(text)
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = max(int(np.searchsorted(ends, before + most, side="right")), first + 1)
            yield batch.slice(first, last - first)
            first = last
        del batch, column
    release()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return whole, offsets - offsets[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of every word; rows end words as separators do."""
    size = len(data)
    if not size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    blank = separator[data]
    row_start = np.zeros(size + 1, dtype=bool)
    row_start[offsets] = True
    after_gap = row_start[:-1].copy()
    after_gap[1:] |= blank[:-1]
    before_gap = row_start[1:].copy()
    before_gap[:-1] |= blank[1:]
    before_gap[-1] = True
    return np.flatnonzero(after_gap & ~blank), np.flatnonzero(before_gap & ~blank) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every span of bytes, lower-cased; spans are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        first = starts[done]
        upto = int(np.searchsorted(ends, first + BLOCK_BYTES, side="right"))
        upto = max(upto, done + 1)
        last = ends[upto - 1]
        up, down = _power_tables(int(last - first) + 1)
        sums = np.zeros(last - first + 1, dtype=np.uint64)
        np.cumsum(_LOWERED[data[first:last]] * up[: last - first], out=sums[1:])
        at = starts[done:upto] - first
        out[done:upto] = (sums[ends[done:upto] - first] - sums[at]) * down[at]
        done = upto
    return mix(out)


def word_hashes(
    column: pa.Array, separator: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the index of each row's first word (and the end)."""
    data, offsets = text_bytes(column)
    starts, ends = word_spans(data, offsets, separator)
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets).astype(np.int64)


def grams(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words; position i is the run that begins there."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, np.uint64(length), dtype=np.uint64)
    for place in range(length):
        total += words[place : place + count] * _GRAM[place]
    return mix(total)


def shingle_sets(
    column: pa.Array, length: int, separator: np.ndarray = SPACE
) -> Iterator[np.ndarray]:
    """Each row's distinct shingles, sorted; a shorter text is one shingle, an empty one none."""
    words, offsets = word_hashes(column, separator)
    whole = grams(words, length)
    for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if last - first >= length:
            yield np.unique(whole[first : last - length + 1])
        elif last > first:
            yield grams(words[first:last], last - first)
        else:
            yield whole[:0]
