"""Arrow batches as bounded groups of rows, for operators that run numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20


def text_slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows with about `limit` bytes of text, their bytes and row offsets.

    A null text counts as empty. One row longer than the limit is a slice of its own.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield (
            batch.slice(begin, end - begin),
            data[offsets[begin] : offsets[end]],
            offsets[begin : end + 1] - offsets[begin],
        )
        begin = end


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
