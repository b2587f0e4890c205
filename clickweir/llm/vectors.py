"""Checked vectors of an embedding column, an Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# squared lengths that are exact enough, and whose products neither overflow nor vanish
SMALLEST, LARGEST = 1e-150, 1e150


def usable_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows hold a usable vector, and those vectors as doubles.

    Null and empty vectors, zero ones, and those that hold a null or a non-finite component
    are not usable. A vector whose length overflows or vanishes in doubles is multiplied by a
    power of two, which changes no cosine.
    """
    usable = np.zeros(len(column), dtype=bool)
    vectors = []
    for i in range(len(column)):
        value = column[i]
        if not value.is_valid:
            continue
        parts = value.values
        if not len(parts) or parts.null_count:
            continue
        vector = parts.cast(pa.float64()).to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            norm = np.dot(vector, vector)
        if not SMALLEST < norm < LARGEST:
            largest = np.abs(vector).max()
            if not np.isfinite(largest) or not largest:
                continue
            vector = np.ldexp(vector, -int(np.frexp(largest)[1]))
        usable[i] = True
        vectors.append(vector)
    return usable, vectors


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``left`` with that of ``right``; equal rows give equal values."""
    dots = (left * right).sum(axis=1)
    return dots / np.sqrt((left * left).sum(axis=1) * (right * right).sum(axis=1))

