"""Columns of Arrow batches a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a column that a worker works on at once (one longer row is taken alone).
SLICE = 1 << 18


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[pa.Array]:
    """``column`` (of texts, bytes or lists) in slices of at most ``limit`` bytes of text or 4-byte elements, or of one row."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        sizes = pc.multiply(pc.fill_null(pc.list_value_length(column), 0).cast(pa.int64()), 4)
    else:
        sizes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
    ends, lo = np.cumsum(sizes.to_numpy(zero_copy_only=False)), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield column.slice(lo, hi - lo)
        lo = hi
    if not len(ends):
        yield column
