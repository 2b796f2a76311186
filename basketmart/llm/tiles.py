"""Buckets of a distributed table, handed to tasks whole and in streams.

``streamed`` sorts rows by bucket within partitions and gives a task runs of whole buckets, many small ones at once, so a
task's memory is that of its largest bucket and the run before it. ``sized`` counts buckets with a map-side combine, drops
those of one row and tells the wide ones apart, so no wide bucket is ever sent to a task to be measured.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.session import stored


def sized(rows: DataFrame, wide: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of buckets with 2 to ``wide`` rows, with ``bucket_rows``; rows of wider ones (None if there are none)."""
    counts = stored(rows.groupBy("bucket").agg(F.count("*").alias("bucket_rows")).filter("bucket_rows > 1"))
    rows = rows.join(counts, "bucket")
    small = rows.filter(F.col("bucket_rows") <= wide)
    if counts.filter(F.col("bucket_rows") > wide).isEmpty():
        return small, None
    return small, rows.filter(F.col("bucket_rows") > wide).drop("bucket", "bucket_rows")


def _bucket_ends(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Places after the last row of each bucket but the batch's last one, which may go on in the next batch."""
    changes = np.zeros(batch.num_rows - 1, bool)
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        changes |= values[1:] != values[:-1]
    return np.flatnonzero(changes) + 1


def streamed(
    rows: DataFrame, keys: list[str], work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, run: int
) -> DataFrame:
    """``work`` on runs of whole buckets: of about ``run`` rows, or one bucket. ``keys`` are columns of numbers."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, run):
                held.append(batch.slice(at, run))
                whole = held[0] if len(held) == 1 else pa.concat_batches(held)
                ends = _bucket_ends(whole, keys) if whole.num_rows > 1 else ()
                held = [whole]
                if len(ends):
                    yield whole.slice(0, ends[-1])
                    held = [whole.slice(ends[-1])]
        if held and held[0].num_rows:
            yield pa.concat_batches(held)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield work(piece)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(task, schema)
