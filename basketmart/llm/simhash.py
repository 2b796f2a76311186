"""Near-duplicates by SimHash: pigeonhole blocks, join on equal blocks, exact Hamming distance.

Sixty-four bits are split into blocks, two more than the bits that may differ, so two fingerprints that are close agree in
at least two whole blocks. Each choice of two blocks makes a bucket of all fingerprints with those bits; buckets are tested
pair by pair. A bucket too wide for that is split again by the same rule over the bits it leaves free: close fingerprints
of the bucket agree in two of the smaller blocks. Every split fixes half of the free bits or more, so after a few splits a
bucket has fewer than WIDE places for distinct fingerprints, however many documents there are.

Documents of one fingerprint are one node; a bucket returns at most one link less than it has nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.components import components
from basketmart.llm.text import as_bytes, read_table, sliced
from basketmart.llm.tiles import sized, streamed
from basketmart.session import stored

BITS = 2  # bits in which linked fingerprints may differ
WIDE = 256  # fingerprints of a bucket that is tested pair by pair
TILE = 65_536  # shingles whose bits are counted at once
SEED = 42
_HASH = xxhash.xxh64_intdigest


def fingerprint(words: list[bytes], size: int) -> int:
    """Unsigned; bit i is set if it is set in more than half of the shingles' XXH64. Without words: zero."""
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    ones = np.zeros(64, np.int64)
    n = len(words) - size + 1
    for low in range(0, n, TILE):
        high = min(low + TILE, n)
        spans = zip(starts[low:high], ends[low + size - 1 : high + size - 1])
        codes = np.array([_HASH(joined[s : e - 1], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id`` and ``code``, the fingerprint as a signed number, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            codes = [fingerprint(body.as_py().lower().split(), size) for body in batch.column(1)]
            codes = pa.array(np.array(codes, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes], ["doc_id", "code"])

    return as_bytes(docs).mapInArrow(run, "doc_id long, code long")


def splits(fixed: int, bits: int) -> list[int]:
    """Masks of bits to agree in: ``fixed`` and two of ``bits`` + 2 blocks of the bits it leaves free."""
    free = [i for i in range(64) if not fixed >> i & 1]
    blocks = np.array_split(np.array(free), bits + 2)
    masks = [sum(1 << int(i) for i in block) for block in blocks]
    return [fixed | x | y for x, y in combinations(masks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _joining(codes: np.ndarray, bucket: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each code with the first one it reaches within its bucket."""
    a, b = [], []
    cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1, append=bucket[-1] + 1))
    for low, high in zip(cuts[:-1], cuts[1:]):
        own = codes[low:high]
        if len(own) == 2:
            if int(own[0] ^ own[1]).bit_count() <= bits:
                a.append(own[:1]), b.append(own[1:])
            continue
        near = np.bitwise_count(own[:, None] ^ own[None, :]) <= bits
        label, old = np.arange(len(own)), None
        while old is None or (label != old).any():
            old, label = label, np.where(near, label[None, :], len(own)).min(axis=1)
        moved = label != np.arange(len(own))
        a.append(own[label[moved]]), b.append(own[moved])
    return (np.concatenate(a), np.concatenate(b)) if a else (codes[:0], codes[:0])


def close_codes(codes: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``a``, ``b`` that join all codes reachable over steps of at most ``bits`` differing bits.

    ``codes`` has distinct values in ``code``. All links found hold, or follow from ones that hold.
    """

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        code, bucket = (rows.column(name).to_numpy() for name in ("code", "bucket"))
        a, b = _joining(code.view(np.uint64), bucket, bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    spark = codes.sparkSession
    wide, masks, found = codes.withColumn("mask", F.lit(0).cast("long")), [0], None
    while wide is not None:
        # with two bits six masks for each of the level above and three levels: bounded, whatever the data
        made = [(_signed(m), _signed(s)) for m in masks for s in splits(m, bits)]
        masks = sorted({s % (1 << 64) for _, s in made})
        rows = wide.join(F.broadcast(spark.createDataFrame(made, "mask long, finer long")), "mask")
        rows = rows.select("code", F.col("finer").alias("mask"))
        if len(masks) < len(made):  # a mask is reached by several ways
            rows = rows.distinct()
        rows = rows.withColumn("bucket", F.xxhash64("mask", F.col("code").bitwiseAND(F.col("mask"))))
        small, wide = sized(rows, WIDE)
        links = streamed(small.select("code", "bucket"), ["bucket"], work, "a long, b long", 4 * WIDE)
        found = links if found is None else found.union(links)
        wide = None if wide is None else stored(wide.select("code", "mask"))
    return found


def near_duplicates(docs: DataFrame, size: int = 5, bits: int = BITS) -> DataFrame:
    """For each row: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    Words are split at blanks, A-Z lower-cased; shingles of ``size`` words are hashed with their repeats. A text of fewer
    words is one shingle. Null texts and texts without words have the fingerprint zero and are linked like any other.
    Fingerprints are linked where at most ``bits`` bits differ. Repeated ids are rows as others; rows without an id take
    part, but name a component only as null, where no row of it has an id. An empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, size))
    nodes = stored(rows.groupBy("code").agg(F.min("doc_id").alias("first_id")))
    joined = components(stored(close_codes(nodes.select("code"), bits)))
    nodes = nodes.join(joined.select(F.col("node").alias("code"), "component"), "code", "left")
    nodes = stored(nodes.select("code", "first_id", F.coalesce("component", "code").alias("component")))
    names = nodes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = nodes.join(names, "component").select("code", "component_id")
    shown = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return rows.join(named, "code").select("doc_id", shown.alias("fingerprint"), "component_id")


def op12_simhash_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"), size=3, bits=2)
