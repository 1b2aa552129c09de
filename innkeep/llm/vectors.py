"""Arrow lists of numbers as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(col: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable vectors, their rows as doubles). Unusable: null, or with null or non-finite components.

    Shorter vectors are padded with zeros to ``width`` (the longest, if not given); longer ones are then unusable.
    """
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(col)
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten()
    v = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    width = int(size.max(initial=0)) if width is None else width
    ok = col.is_valid().to_numpy(zero_copy_only=False) & (size <= width)
    owner = np.repeat(np.arange(n), size)
    place = np.arange(len(v)) - np.repeat(np.cumsum(size) - size, size)
    ok[owner[~np.isfinite(v)]] = False
    out = np.zeros((n, width))
    keep = ok[owner]
    out[owner[keep], place[keep]] = v[keep]
    at = np.flatnonzero(ok)
    return at, out[at]
