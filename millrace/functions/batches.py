"""Arrow batches in steps of bounded size: a batch has 10,000 rows, whatever they hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of strings, or so many elements of lists, that a step works on at a time; one longer row is a step of its own.
STEP = 1 << 20


def ends(sizes: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """(begin, end) of stretches of rows whose sizes add up to no more than limit, or of one row."""
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = int(total[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield begin, end
        begin = end


def sizes_of(values: pa.Array) -> np.ndarray:
    """The bytes of strings or the elements of lists, 0 for a null."""
    import pyarrow.compute as pc

    lengths = pc.list_value_length(values) if pa.types.is_list(values.type) or pa.types.is_large_list(values.type) else pc.binary_length(values)
    return np.asarray(pc.fill_null(lengths, 0), np.int64)


def steps(values: pa.Array | pa.ChunkedArray, limit: int = STEP) -> Iterator[pa.Array]:
    """An array in slices of bounded size; at least one."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    if not len(values):
        yield values
    for a, b in ends(sizes_of(values), limit):
        yield values.slice(a, b - a)
