"""Near-duplicates by circulant MinHash, banding and exact verification.

Signature: one fixed permutation scatters the shingles over a ring of 2^32 places, a second one is shifted along the ring
by k to give coordinate k, so two permutations make all coordinates. Both are bijections of 32-bit integers (odd
multiplications and xor-shifts). Coordinates are cut into bands; equal bands make candidates.

Candidates are never paired within a bucket of any size at once:

1. Copies (same words) are one representative, by a map-side aggregation.
2. Each representative is checked against the smallest one of each of its buckets; exact links give components.
3. Buckets that still hold several components are cut into blocks. A block gets the shingle sets of its rows, finds exact
   intersections block by block and returns only the links that join something. Two blocks whose rows are all in the
   bucket's main component are not compared. So no link between candidates of one bucket is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.components import components
from basketmart.llm.text import as_bytes, by_batch, read_table, shingles
from basketmart.session import stored

BANDS, ROWS = 20, 4
BLOCK = 256  # rows of a block
BLOCK_SHINGLES = 500_000  # of a block in all, as far as its rows can be told apart
TILE = 4096  # shingles handled at once


def _permute(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A bijection of uint32."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(1, BANDS * ROWS + 1, dtype=np.uint32)[:, None]


def signature(codes: np.ndarray) -> np.ndarray:
    """BANDS x ROWS coordinates of a non-empty set of 64-bit fingerprints."""
    ring = _permute((codes ^ (codes >> np.uint64(32))).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    best = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(ring), TILE):
        shifted = _permute(ring[None, at : at + TILE] + _SHIFTS, 0x7FEB352D, 0x846CA68B)
        np.minimum(best, shifted.min(axis=1), out=best)
    return best


def bands(codes: np.ndarray) -> list[int]:
    """One 64-bit key for each band, the band's number mixed in."""
    parts = signature(codes).reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = (key ^ parts[:, r]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64).tolist()


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``body`` and ``key``, which is the same for rows of the same id and text only."""
    return as_bytes(docs).withColumn("key", F.xxhash64("doc_id", "body"))


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _described(docs: DataFrame, size: int) -> DataFrame:
    """For each row: digest of its words, number of shingles, band keys (none for a text without words)."""

    def work(columns):
        ids, row_keys, bodies = columns
        digests, counts, keys = [], [], []
        last = {}
        for body in bodies:
            words = body.lower().split()
            digest = _digest(words)
            if digest not in last:
                codes = shingles(words, size)
                last[digest] = (len(codes), bands(codes) if len(codes) else None)
            digests.append(digest)
            counts.append(last[digest][0])
            keys.append(last[digest][1])
        return [ids, row_keys, digests, counts, keys]

    schema = "doc_id long, key long, digest binary, n_shingles long, bands array<long>"
    return by_batch(_keyed(docs), work, schema, ["doc_id", "key", "body"])


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``body`` of the representatives in ``wanted``; rows whose words differ from theirs are left out."""
    rows = _keyed(docs).select("key", "body").join(wanted.hint("merge"), "key").select("node", "digest", "body")

    def work(columns):
        good = [(n, b) for n, d, b in zip(*columns) if _digest(b.lower().split()) == d]
        return [[n for n, _ in good], [b for _, b in good]]

    return by_batch(rows, work, "node long, body binary", ["node", "digest", "body"]).dropDuplicates(["node"])


def _linked(pairs_of: Iterator[tuple[np.ndarray, np.ndarray]], percent: int) -> list[bool]:
    """Whether 100 * intersection >= percent * union, for pairs of sorted distinct arrays."""
    out = []
    for a, b in pairs_of:
        small, large = min(len(a), len(b)), max(len(a), len(b))
        if 100 * small < percent * large:
            out.append(False)
            continue
        where = np.searchsorted(a, b)
        where[where == len(a)] = 0
        common = int((a[where] == b).sum())
        out.append(100 * common >= percent * (len(a) + len(b) - common))
    return out


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (rep, other) whose full sets are similar enough."""
    left = texts.select(F.col("node").alias("rep"), F.col("body").alias("x"))
    right = texts.select(F.col("node").alias("other"), F.col("body").alias("y"))
    both = pairs.join(left, "rep").join(right, "other").select("rep", "other", "x", "y")

    def work(columns):
        reps, others, xs, ys = columns
        sets: dict[bytes, np.ndarray] = {}

        def of(body: bytes) -> np.ndarray:
            if body not in sets:
                if len(sets) > 2000:
                    sets.clear()
                sets[body] = shingles(body.lower().split(), size)
            return sets[body]

        good = _linked(((of(x), of(y)) for x, y in zip(xs, ys)), percent)
        return [[r for r, g in zip(reps, good) if g], [o for o, g in zip(others, good) if g]]

    return by_batch(both, work, "a long, b long", ["rep", "other", "x", "y"])


def _within_block(rows: pd.DataFrame, size: int, percent: int) -> pd.DataFrame:
    """Links that join components among the rows of one block; exact, at most one less than there are rows."""
    rows = rows.drop_duplicates("doc_id").reset_index(drop=True)
    sets = [shingles(body.lower().split(), size) for body in rows["body"]]
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = np.bincount(at, minlength=len(every)) > 1
    number = np.cumsum(shared) - 1
    use = shared[at]
    owner, at = owner[use], number[at[use]]
    common = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), TILE):
        part = (at >= low) & (at < low + TILE)
        seen = np.zeros((n, TILE), np.float32)
        seen[owner[part], at[part] - low] = 1
        common += seen @ seen.T
    union = sizes[:, None] + sizes[None, :] - common
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    first: dict[int, int] = {}
    for i, c in enumerate(rows["component"]):
        if c in first:
            root[find(i)] = find(first[c])
        else:
            first[c] = i
    found = []
    for i, j in np.argwhere(np.triu(100 * common >= percent * union, 1)):
        x, y = find(int(i)), find(int(j))
        if x != y:
            root[x] = y
            found.append((rows["doc_id"][i], rows["doc_id"][j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _blocks(active: DataFrame) -> DataFrame:
    """Rows of buckets with several components, each sent to the blocks it is compared in.

    Rows of a bucket are numbered within (bucket, salt) only, so no bucket is ever sorted by one task: chunk = salt, with
    as many salts as the bucket has rows / BLOCK, or shingles / BLOCK_SHINGLES where its texts are long. Rows outside the
    main component have chunks of their own.
    """
    each = active.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    total = each.groupBy("bucket").agg(
        F.max_by(F.struct("component", "n", "size"), F.struct("n", -F.col("component"))).alias("main"),
        F.sum("n").alias("n"),
        F.sum("size").alias("size"),
        F.count("*").alias("parts"),
    )

    def chunks(n: Column, size: Column) -> Column:
        return F.ceil(F.greatest(n / BLOCK, F.least(size / BLOCK_SHINGLES, n))).cast("int")

    total = total.filter("parts > 1").select(
        "bucket",
        F.col("main.component").alias("main"),
        chunks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size")).alias("rest"),
        chunks(F.col("main.n"), F.col("main.size")).alias("mains"),
    )
    rows = active.join(total, "bucket").withColumn("is_main", F.col("component") == F.col("main"))
    chunk = F.when(
        F.col("is_main"), F.col("rest") + F.pmod(F.xxhash64("node"), F.col("mains").cast("long")).cast("int")
    ).otherwise(F.pmod(F.xxhash64("node"), F.col("rest").cast("long")).cast("int"))
    rows = rows.withColumn("chunk", chunk)
    # rest x rest and rest x main: a main chunk meets all rest chunks, a rest chunk meets every chunk
    other = F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("rest") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("rest") + F.col("mains") - 1)
    )
    return rows.select("bucket", "node", "component", "chunk", F.explode(other).alias("other")).select(
        "bucket",
        "node",
        "component",
        F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"),
    )


def classes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """For each row: ``doc_id``, ``key`` (of its id and text), ``n_shingles`` and ``node``, the number of its component,
    null for a text without words. Numbers differ from run to run.

    Different texts are told apart by a digest of their words, whatever their ids, and numbered once.
    """
    described = stored(_described(docs, size))
    groups = described.filter("n_shingles > 0").groupBy("digest").agg(
        F.min_by(F.struct("key", "bands", "n_shingles"), "key").alias("r")
    )
    reps = stored(groups.select("digest", "r.*").withColumn("node", F.monotonically_increasing_id()))
    members = reps.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    centres = members.groupBy("bucket").agg(F.min("node").alias("other"), F.count("*").alias("n")).filter("n > 1")
    members = stored(members.join(centres.select("bucket", "other"), "bucket"))
    pairs = stored(members.filter("node <> other").select(F.col("node").alias("rep"), "other").distinct())
    wanted = pairs.select(F.col("rep").alias("node")).union(pairs.select("other")).distinct()
    # the same plan at every size: Spark's guess at the keys' size would choose between two very different ones
    texts = stored(_texts(docs, reps.select("node", "key", "digest").join(wanted, "node")))
    links = stored(_verified(pairs, texts, size, percent))
    first = components(links)
    active = members.select("bucket", "node", "n_shingles").join(first, "node", "left")
    active = active.withColumn("component", F.coalesce("component", "node"))
    # a bucket of two was settled by its only pair
    sizes = active.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("c1"), F.max("component").alias("c2")
    )
    active = active.join(sizes.filter("n > 2 and c1 <> c2").select("bucket"), "bucket", "left_semi")
    dealt = _blocks(active).join(texts, "node").withColumnRenamed("node", "doc_id")
    more = stored(
        dealt.groupBy("bucket", "low", "high").applyInPandas(
            lambda rows: _within_block(rows, size, percent), "a long, b long"
        )
    )
    # links of the blocks join components, so only components take part in the second round
    for side in ("a", "b"):
        named = first.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
        more = more.join(named, side, "left").withColumn(f"{side}_component", F.coalesce(f"{side}_component", side))
    joined = components(more, "a_component", "b_component")
    numbers = reps.select("digest", "node").join(first, "node", "left")
    numbers = numbers.select("digest", F.coalesce("component", "node").alias("first_node")).join(
        joined.select(F.col("node").alias("first_node"), "component"), "first_node", "left"
    )
    numbers = numbers.select("digest", F.coalesce("component", "first_node").alias("node"))
    return described.select("doc_id", "key", "digest", "n_shingles").join(numbers, "digest", "left").drop("digest")


def _with_ids(found: DataFrame) -> DataFrame:
    """``found`` with ``component_id`` and ``kept``."""
    ids = found.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("smallest"))
    out = found.join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return out.withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """For each row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``.

    A text of fewer than ``size`` words is one shingle, its whole sequence; a text without words (or null) has none and is
    linked with nothing. Documents are linked where ``100 * intersection >= percent * union``. Rows of the same id are
    each described by their own text and share a component if linked; a row without an id takes its component's smallest
    id, and is kept, with a null one, where no row of the component has any. ``kept`` is never null. Empty input gives an
    empty result. Shingles are compared by 64-bit fingerprints. With 20 bands of 4 rows a pair of similarity 0.85 is
    missed as a candidate with probability 4e-7, one of 0.8 with 3e-5; there are no caps on buckets.
    """
    found = _with_ids(stored(classes(docs, size, percent)))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without words, and of each component one text: that of the smallest id (null after all
    others), of the smallest hash where ids repeat. Rows repeated with id and text are told apart by nothing, so all of a
    text that stays do. The columns are those of ``docs``.
    """
    found = stored(_with_ids(stored(classes(docs, size, percent))).filter("node is not null"))
    heads = found.filter("kept").groupBy("node").agg(F.min("key").alias("stays"), F.max("key").alias("last"))
    heads = heads.filter("stays <> last").select("node", "stays")  # where the id does not decide
    others = found.filter("kept").join(heads, "node").filter("key <> stays")
    rejected = found.filter(~F.col("kept")).select("key").union(others.select("key")).distinct()
    own = F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(F.encode(docs["text"], "UTF-8"), F.lit(b"")))
    return docs.join(rejected, own == rejected["key"], "left_anti").select(*docs.columns)


def op6_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"), size=3, percent=85)
