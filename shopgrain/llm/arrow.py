"""Arrow batches: texts as byte arrays without copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


_TOGETHER = 1 << 17


def texts_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """UTF-8 bytes of a few texts at a time and the bounds of each; a null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    if not len(column):
        return
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    k = 0
    while k < len(column):
        end = max(int(np.searchsorted(at, at[k] + _TOGETHER, "right")) - 1, k + 1)
        yield data[at[k] : at[end]], at[k : end + 1] - at[k]
        k = end


def bytes_of(column: pa.Array) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text."""
    for data, bounds in texts_of(column):
        for k in range(len(bounds) - 1):
            yield data[bounds[k] : bounds[k + 1]]


def compact(column: pa.Array) -> pa.Array:
    """The texts as large strings in buffers of their own, a null as empty one.

    Some functions of Arrow, `ascii_lower` among them, garble what a cast of a
    slice returns.
    """
    return column.take(longs(np.arange(len(column)))).cast(pa.large_string()).fill_null("")


def bounds_of(column: pa.Array) -> np.ndarray:
    """Where the bytes of each large string start in its buffer, and where the last one's end."""
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One list per array."""
    ends = np.cumsum([0, *(len(x) for x in arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
