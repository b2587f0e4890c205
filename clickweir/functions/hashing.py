"""Stable non-negative 63-bit hashes of text, used as surrogate ids."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("xxhash64", "compat")


def text_hash(text: Column, method: str = "xxhash64") -> Column:
    """Hash text to a BIGINT >= 0; NULL stays NULL.

    ``xxhash64`` is a built-in and stays inside generated code; use it unless
    ids have to match ones already stored. ``compat`` reproduces those ids with
    a vectorised Arrow function.
    """
    if method == "xxhash64":
        return F.when(text.isNotNull(), F.shiftrightunsigned(F.xxhash64(text), 1))
    if method == "compat":
        return _compat_udf()(text)
    raise ValueError(f"unknown hash method {method!r}; expected one of {METHODS}")


def text_hash_items(items: Column, method: str = "xxhash64") -> Column:
    """``text_hash`` of every element of an array of text."""
    if method == "compat":
        return _compat_items_udf()(items)
    return F.transform(items, lambda item: text_hash(item, method))


def compat_kernel():
    """Function from an Arrow string array to an Arrow int64 array of hashes.

    The body is self-contained so that it travels to the workers by value.
    """

    def hash_array(values):
        import numpy as np
        import pyarrow as pa

        # Seed, start of the third word, and the mixing schedule
        # (a public 64-bit mixing function): bit distances, right unless noted.
        seed = 200
        third_word = -7046029254386353133
        schedule = (
            (43, "right"), (9, "left"), (8, "right"),
            (38, "right"), (23, "left"), (5, "right"),
            (35, "right"), (49, "left"), (11, "right"),
            (12, "right"), (18, "left"), (22, "right"),
        )
        block = 24

        def mix(words):
            for step, (distance, direction) in enumerate(schedule):
                target = words[step % 3]
                after = words[(step + 1) % 3]
                last = words[(step + 2) % 3]
                target -= after
                target -= last
                amount = np.uint64(distance)
                target ^= last >> amount if direction == "right" else last << amount

        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        values = values.cast(pa.large_binary())
        count = len(values)
        if count == 0:
            return pa.array([], pa.int64())
        _, offset_buffer, data_buffer = values.buffers()
        offsets = np.frombuffer(offset_buffer, np.int64)[
            values.offset : values.offset + count + 1
        ]
        first, last = int(offsets[0]), int(offsets[-1])
        held = np.frombuffer(data_buffer, np.uint8)[first:last] if last > first else ()
        data = np.concatenate([np.asarray(held, np.uint8), np.zeros(block, np.uint8)])
        start = offsets[:-1] - first
        length = np.diff(offsets)
        blocks = length // block

        # Longest first, so the rows still active at block i are a leading slice.
        order = np.argsort(-blocks, kind="stable")
        start, length, blocks = start[order], length[order], blocks[order]
        words = [np.full(count, seed, np.uint64) for _ in range(2)]
        words.append(np.full(count, third_word, np.int64).view(np.uint64))
        lane = np.arange(block)
        descending = -blocks

        def load(positions):
            return data[np.minimum(positions[:, None] + lane, len(data) - 1)]

        for index in range(int(blocks[0])):
            active = int(np.searchsorted(descending, -index, side="left"))
            piece = load(start[:active] + index * block).view("<u8")
            view = [word[:active] for word in words]
            for number in range(3):
                view[number] += piece[:, number]
            mix(view)

        rest = length - blocks * block
        tail = load(start + blocks * block)
        tail[lane >= rest[:, None]] = 0
        tail = tail.view("<u8")
        words[2] += length.astype(np.uint64)
        words[0] += tail[:, 0]
        words[1] += tail[:, 1]
        words[2] += tail[:, 2] << np.uint64(8)
        mix(words)

        result = np.empty(count, np.int64)
        result[order] = (words[2] >> np.uint64(1)).astype(np.int64)
        missing = values.is_null().to_numpy(zero_copy_only=False)
        return pa.array(result, pa.int64(), mask=missing)

    return hash_array


def _compat_udf():
    kernel = compat_kernel()

    def compat_hash(values: pa.Array) -> pa.Array:
        return kernel(values)

    return F.arrow_udf(compat_hash, "bigint")


def _compat_items_udf():
    kernel = compat_kernel()

    def compat_hash_items(lists: pa.Array) -> pa.Array:
        lists = pa.concat_arrays([lists])  # drops any slice offset
        missing = lists.is_null()
        return pa.ListArray.from_arrays(lists.offsets, kernel(lists.values), mask=missing)

    return F.arrow_udf(compat_hash_items, "array<bigint>")
