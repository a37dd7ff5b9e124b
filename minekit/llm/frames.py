"""Arrow helpers shared by the row-wise operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Text bytes that one numpy step works on (its tables take some 50 bytes per byte); a
#: longer single text forms its own step.
STEP_BYTES = (1 << 20) - (1 << 12)


def steps(values: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[pa.Array]:
    """Slices of ``values`` (strings or lists) of about ``step_bytes`` each
    (an element of a list counts as one byte); rows hold at least one byte."""
    if len(values) == 0:
        return
    lengths = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(values):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(ends.searchsorted(base + step_bytes, side="right")))
        yield values.slice(at, stop - at)
        at = stop


def release_memory() -> None:
    """Gives a worker's free memory back to the system at the end of a task.

    Spark keeps idle workers for later stages; what they hold on to counts
    against the executor all the same."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):       # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def append_columns(df: DataFrame, column: str, fields: list[tuple[str, DataType]],
                   make: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """``df`` with ``fields`` computed from ``column`` by Arrow batch.

    ``make()`` runs once per task and returns the function that maps a slice
    of the column to one Arrow array per field.  Columns of ``df`` that are
    named like a field are replaced; all others pass through untouched.
    """
    names = [n for n, _ in fields]
    source = "__source"
    while source in df.columns:
        source += "_"
    kept = [c for c in df.columns if c not in names]
    base = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(source))
    schema = StructType([base.schema[c] for c in kept] + [StructField(n, t, True) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            at, src = 0, batch.schema.get_field_index(source)
            for part in steps(batch.column(src)):
                rows = batch.slice(at, len(part))
                at += len(part)
                cols = [rows.column(i) for i in range(rows.num_columns) if i != src]
                yield pa.RecordBatch.from_arrays(cols + work(part), names=kept + names)
        release_memory()

    return base.mapInArrow(run, schema)
