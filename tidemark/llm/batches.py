"""Helpers to run numpy and Python work inside Spark tasks, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Text bytes that a task holds as Python objects at one time.
SLICE_BYTES = 4 << 20

_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
    "array<struct<kind:string,start:int,end:int>>": pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    ),
}

Columns = dict[str, list]


def slices(batch: pa.RecordBatch, most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice of several rows holds more than ``most_bytes`` of text."""
    size = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < batch.num_rows:
        total = np.cumsum(size[start:])
        stop = start + max(1, int(np.searchsorted(total, most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def to_list(column: pa.Array) -> list:
    """Python values; bytes of a text that are no UTF-8 become U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [x if x is None else x.decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def to_array(values, kind: str) -> pa.Array:
    if isinstance(values, pa.Array):
        return values
    return pa.array(values, type=_ARROW[kind])


def add_columns(
    frame: DataFrame,
    keep: list[str],
    read: list[str],
    work: Callable[[], Callable[[Columns], Columns]],
    added: dict[str, str],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``keep`` as it is and the ``added`` columns, one output row for each input row.

    ``work()`` runs once in each task and returns the function that gets the
    ``read`` columns of a slice as lists and returns the added ones.
    """
    fresh = StructType.fromDDL(", ".join(f"`{c}` {kind}" for c, kind in added.items()))
    schema = StructType([StructField(c, frame.schema[c].dataType) for c in keep] + fresh.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            for part in slices(batch, slice_bytes):
                out = step({c: to_list(part.column(c)) for c in read})
                arrays = [part.column(c) for c in keep] + [to_array(out[c], kind) for c, kind in added.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *added])

    return frame.select(*dict.fromkeys([*keep, *read])).mapInArrow(run, schema)


def emit_rows(
    frame: DataFrame,
    read: list[str],
    work: Callable[[], Callable[[Iterator[Columns]], Iterator[Columns]]],
    schema: dict[str, str],
) -> DataFrame:
    """Any number of output rows: the function ``work()`` returns goes over the slices of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ({c: to_list(part.column(c)) for c in read} for batch in batches for part in slices(batch))
        for out in work()(parts):
            yield pa.RecordBatch.from_arrays([to_array(out[c], kind) for c, kind in schema.items()], names=list(schema))

    return frame.select(*read).mapInArrow(run, ", ".join(f"`{c}` {kind}" for c, kind in schema.items()))
