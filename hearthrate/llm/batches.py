"""Arrow batches in mapInArrow: slices of bounded bytes, and added columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, types as T

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts hold at most ``limit`` bytes each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns],
    )


def with_names(df: DataFrame, added: dict[str, T.DataType]) -> T.StructType:
    """The schema of ``df`` with nullable columns added."""
    schema = T.StructType(list(df.schema.fields))
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return schema
