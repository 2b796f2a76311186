"""Bounded-space online packing of token ids into sequences of a fixed length.

Each partition keeps a fixed number of open windows. A document's remainder (what is left after its full windows) goes to
the window it fits best. Where it fits none, the fullest window is completed with the document's first ids, or, where its
gap is below ``LEAST`` ids, is left with that padding; it is emitted, and the rest is placed again. Windows still open at
the end of a partition are merged, in groups of a bounded number of windows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import as_bytes, read_table, sliced
from basketmart.llm.wordbpe import word_ids
from basketmart.session import stored

LENGTH = 4096
OPEN = 64  # windows kept open
LEAST = 16  # ids of the smallest piece cut off to fill a window
END = 2  # id after each document
GROUP = 4096  # windows merged together
_SHIFT = 40  # sequence_id = partition << 40 | number

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, left boolean"
)


class Packer:
    """Open windows of one partition, as (free ids, number of the sequence)."""

    def __init__(self, length: int = LENGTH, keep: int = OPEN):
        self.length, self.keep, self.count = length, keep, 0
        self.open: list[tuple[int, int]] = []

    def _new(self) -> int:
        self.count += 1
        return self.count - 1

    def place(self, size: int) -> list[tuple[int, int, int]]:
        """Pieces (length, sequence, offset) of a document of ``size`` ids, in order."""
        out = []
        while size >= self.length:
            out.append((self.length, self._new(), 0))
            size -= self.length
        while size:
            at = bisect_left(self.open, (size, -1))
            if at < len(self.open):  # the smallest gap that is large enough
                free, number = self.open.pop(at)
            elif len(self.open) < self.keep:
                free, number = self.length, self._new()
            else:
                free, number = self.open.pop(0)
                if free >= LEAST:
                    out.append((free, number, self.length - free))
                    size -= free
                continue
            out.append((size, number, self.length - free))
            if free > size:
                insort(self.open, (free - size, number))
            size = 0
        return out


def _pack(docs: DataFrame, path: str | None, length: int, keep: int) -> DataFrame:
    """Pieces of each partition; ``left`` marks those in windows that were open at its end."""
    names = [part.split()[0] for part in PIECES.split(", ")]
    kinds = [pa.bool_() if name == "left" else pa.int64() for name in names]
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = Packer(length, keep), TaskContext.get().partitionId() << _SHIFT
        waiting: dict[int, list[tuple]] = {}

        def batch_of(rows: list[tuple], left: bool) -> pa.RecordBatch:
            columns = list(zip(*rows)) + [[left] * len(rows)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        encoder = word_ids(path)
        for batch in sliced(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                ids += end
                total, start = len(ids) // 4, 0
                for size, number, offset in packer.place(total):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                    piece = (doc_id, start, size, crc, total, first + number, offset)
                    waiting.setdefault(number, []).append(piece)
                    start += size
            still = {number for _, number in packer.open}
            closed = [piece for number in [n for n in waiting if n not in still] for piece in waiting.pop(number)]
            if closed:
                yield batch_of(closed, False)
        if waiting:
            yield batch_of([piece for pieces in waiting.values() for piece in pieces], True)

    return as_bytes(docs).select("doc_id", "body").mapInArrow(run, PIECES)


def _merge(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Put windows into windows, largest first, each where it fits best; pieces keep their cuts."""
    fill = rows.groupby("sequence_id")["length"].sum()
    fill = sorted(((int(n), int(s)) for s, n in fill.items()), key=lambda x: (-x[0], x[1]))
    free: list[tuple[int, int]] = []
    target: dict[int, tuple[int, int]] = {}
    for size, sequence in fill:
        at = bisect_left(free, (size, -1))
        gap, host = free.pop(at) if at < len(free) else (length, sequence)
        target[sequence] = (host, length - gap)
        if gap > size:
            insort(free, (gap - size, host))
    moved = rows["sequence_id"].map(target)
    return rows.assign(sequence_id=moved.str[0], offset=rows["offset"] + moved.str[1])


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, keep: int = OPEN) -> DataFrame:
    """One row for each piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Ids of a text by the word BPE file at ``path``, then id 2; null and empty texts are that id alone. Pieces of a document
    are consecutive; those of a sequence are gapless from 0. Repeated rows are packed each. No rows give no sequences.
    Packing depends on the order of rows within the input's partitions, so a retried task repeats its sequences.
    """
    pieces = stored(_pack(docs, path, length, keep))
    names = [name for name in pieces.columns if name != "left"]
    left = pieces.filter("left").select(*names)
    windows = left.agg(F.count_distinct("sequence_id")).first()[0]
    groups = -(-windows // GROUP) or 1
    schema = ", ".join(f"{name} long" for name in names)
    merged = (
        left.withColumn("part", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
        .groupBy("part")
        .applyInPandas(lambda rows: _merge(rows[names], length), schema)
    )
    return pieces.filter(~F.col("left")).select(*names).unionByName(merged)


def op9_bounded_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"))
