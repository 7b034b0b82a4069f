"""Parts of record batches: groups of neighbouring rows, and texts of a bounded size together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group, named by the first column, as a table; a group may go over several batches."""
    held, key = [], None
    for batch in batches:
        g = batch.column(0).to_numpy()
        cuts = [*(np.flatnonzero(g[1:] != g[:-1]) + 1), len(g)]
        start = 0
        for end in cuts:
            if end == start:
                continue
            if held and g[start] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = g[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


ROWS = 256  # whose texts are held as Python objects at once, at most


def text_parts(batch: pa.RecordBatch, column: str | int, size: int, none: str | bytes = "") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with their texts, about ``size`` characters (or bytes) together, a longer text alone; ``none`` for null."""
    for low in range(0, batch.num_rows, ROWS):
        rows = batch.slice(low, ROWS)
        texts = [none if t is None else t for t in rows.column(column).to_pylist()]
        first, total = 0, 0
        for i, text in enumerate(texts):
            if i > first and total + len(text) > size:
                yield rows.slice(first, i - first), texts[first:i]
                first, total = i, 0
            total += len(text)
        yield rows.slice(first), texts[first:]
