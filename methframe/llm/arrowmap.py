"""Running a per-batch Arrow function while all input columns pass through."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import without

#: Input is handed on in slices of about this size, whatever the size of the batches that arrive.
SLICE_BYTES = 8 << 20


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about SLICE_BYTES, so that a worker's memory does not follow the batch size.

    At the end free memory goes back to the system: workers idle on between tasks, beside those of other steps.
    """
    for whole in batches:
        step = max(1, whole.num_rows * SLICE_BYTES // max(1, whole.nbytes))
        yield from (whole.slice(i, step) for i in range(0, whole.num_rows, step))
        del whole
    release()


def release() -> None:
    """Returns what Arrow and the C library hold free."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def add_columns(df: DataFrame, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """df with further columns (which replace others of their names).

    make() is called once per task and returns the function from a batch to the new columns,
    each an Arrow array or something that makes one.
    """
    df = without(df, *(name for name, _ in fields))
    schema = T.StructType([*df.schema.fields, *(T.StructField(name, kind) for name, kind in fields)])
    kinds = [to_arrow_type(kind) for _, kind in fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in sliced(batches):
            new = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(f(batch), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(run, schema)
