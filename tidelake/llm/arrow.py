"""Arrow columns as flat numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def replaced(batch: pa.RecordBatch, drop: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` without the columns ``drop`` and with ``new`` ones, which win over old ones
    of the same name."""
    names = [n for n in batch.schema.names if n not in drop and n not in new]
    columns = [batch.column(n) for n in names] + list(new.values())
    return pa.RecordBatch.from_arrays(columns, names=[*names, *new])


def slices(batches: Iterable[pa.RecordBatch], text: str | int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of some ``SLICE_BYTES`` of the text column, at least one row each,
    so that what is derived from a part stays small however long the texts are."""
    for batch in batches:
        _, offsets = text_buffers(batch.column(text))
        at, rows = 0, batch.num_rows
        while at < rows:
            to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
            to = min(max(to, at + 1), rows)
            yield batch.slice(at, to - at)
            at = to
