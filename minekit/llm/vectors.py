"""Array columns as packed double vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame, key: str, column: str, zero: bool = True) -> DataFrame:
    """``id long, x binary`` (little-endian doubles) per row of ``df``.

    ``x`` is null for vectors that take no part: null, empty, with null or
    non-finite components, and unless ``zero`` those of zeros only."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1)
            values = x.values.to_numpy(zero_copy_only=False).astype("<f8", copy=False)
            ends, null = x.offsets.to_pylist(), x.is_null().to_pylist()
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            full = np.concatenate([[0], np.cumsum(values != 0)])
            raw = values.tobytes()
            data = [None if n or a == b or bad[b] > bad[a] or not (zero or full[b] > full[a]) else raw[8 * a:8 * b]
                    for n, a, b in zip(null, ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["id", "x"])

    return rows.mapInArrow(run, "id long, x binary")


def stack(rows) -> np.ndarray:
    """Packed vectors of one length as a matrix."""
    rows = list(rows)
    return np.frombuffer(b"".join(rows), dtype="<f8").reshape(len(rows), -1)
