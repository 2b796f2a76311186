"""Helpers the text operators share: whole texts as bytes, words, Arrow batches, readers.

Words are runs of bytes other than 0x20 and 0x09-0x0D, which is what ``bytes.split()`` gives, so a word of the bytes is
a word of the text: UTF-8 never uses those values inside a longer code. ``bytes.lower()`` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def as_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` and ``body``: the text as UTF-8, empty where it is null. Other columns are left behind,
    whatever their names."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b"")).alias("body")
    )


SLICE = 500  # rows a task turns into Python objects at once


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most SLICE rows; Spark's own may hold ten thousand whole texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def by_batch(rows: DataFrame, work: Callable[[list, pa.RecordBatch], list], schema: str, columns: list[str]) -> DataFrame:
    """Map Arrow batches: ``work`` gets the batch and returns one Python list or array for each output column."""
    from pyspark.sql.types import _parse_datatype_string

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = work([batch.column(i).to_pylist() for i in range(len(columns))])
            arrays = [pa.array(values, type=field.type) for values, field in zip(made, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return rows.select(*columns).mapInArrow(run, schema)


def held_out(modulus: int, remainder: int = 2, key: str = "doc_id"):
    """The contract's split: crc32 of the id as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder


def byte_chars() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others as the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
_HASH = xxhash.xxh3_64_intdigest


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit fingerprints of the distinct runs of ``size`` words; of the whole sequence where it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_HASH, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total += codes[k : len(codes) - size + 1 + k]
        total *= np.uint64(_ODD[k % 5])
        total ^= total >> np.uint64(29)
    return np.unique(total)
