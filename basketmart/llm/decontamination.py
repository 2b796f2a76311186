"""Benchmark decontamination by greedy string tiling.

Seeds are runs as long as the smallest tile, three words (or a whole item of one or two words). A document and a benchmark
item become a candidate where the item's words in shared seeds reach the coverage: tiles consist of shared seeds, so no item
that tiles would cover is left out. For a candidate the longest common run of unmarked words is found (binary search on the length, runs compared by Karp-Rabin hashes and then
word by word), all its non-overlapping places are marked as tiles, and so on down to the smallest tile. Coverage is the
share of the item's words that lie in tiles, so the order of the tiles in the document doesn't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import as_bytes, by_batch, read_table, sliced
from basketmart.session import stored

TILE = 3  # words of the smallest tile, and of a seed
COVERAGE = 0.8
BLOCK_BYTES = 16 << 20  # of a benchmark that tasks hold at once; a larger one is looked up in so many blocks

_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15


def word_codes(body: bytes) -> np.ndarray:
    words = _WORD.findall(body.decode("utf-8", "replace").lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def runs(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` codes, by doubling: a run is two shorter ones."""
    if len(codes) < length:
        return np.empty(0, np.uint64)
    total = np.zeros(len(codes) - length + 1, np.uint64)
    done, block, width, power = 0, codes, 1, _BASE
    left = length
    while left:
        if left & 1:
            total = total * np.uint64(power) + block[done : done + len(total)]
            done += width
        left >>= 1
        if left:
            block = block[:-width] * np.uint64(power) + block[width:]
            power, width = power * power % 2**64, width * 2
    return total


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Whether each run of ``length`` has no marked word."""
    if len(marked) < length:
        return np.empty(0, bool)
    seen = np.concatenate(([0], np.cumsum(marked)))
    return seen[length:] == seen[:-length]


def _placed(item, doc, item_marked, doc_marked, length) -> Iterator[int]:
    """Mark equal unmarked runs, by the item's place, then the document's; one number for each.

    A place of the document that has been marked stays so, so each hash needs to look at each place once; memory is that of
    the two texts.
    """
    a, b = runs(item, length), runs(doc, length)
    a_at, b_at = np.flatnonzero(_free(item_marked, length)), np.flatnonzero(_free(doc_marked, length))
    b_at = b_at[np.isin(b[b_at], a[a_at])]
    b_at = b_at[np.argsort(b[b_at], kind="stable")]
    keys = b[b_at]
    low, high = np.searchsorted(keys, a[a_at], "left"), np.searchsorted(keys, a[a_at], "right")
    passed: dict[int, int] = {}
    for i, start, stop in zip(a_at.tolist(), low.tolist(), high.tolist()):
        if start == stop or item_marked[i : i + length].any():
            continue
        k = passed.get(start, start)
        while k < stop and doc_marked[b_at[k] : b_at[k] + length].any():
            k += 1
        passed[start] = k
        for j in b_at[k:stop]:
            if not doc_marked[j : j + length].any() and (item[i : i + length] == doc[j : j + length]).all():
                item_marked[i : i + length] = doc_marked[j : j + length] = True
                yield length
                break


def tile(item: np.ndarray, doc: np.ndarray, smallest: int = TILE) -> tuple[int, int]:
    """Words of the item that tiles cover, and number of tiles."""
    if len(item) < smallest or len(doc) < smallest:
        return 0, 0
    # words of the document outside every common run of the smallest length can't be in a tile
    common = np.isin(runs(doc, smallest), runs(item, smallest))
    near = np.zeros(len(doc) + smallest, int)
    for k in range(smallest):
        near[k : k + len(common)] |= common
    keep = np.flatnonzero(near[: len(doc)])
    if not len(keep):
        return 0, 0
    gaps = np.flatnonzero(np.diff(keep) > 1) + 1
    # a marked place between the pieces, so no run goes across
    doc_marked = np.insert(np.zeros(len(keep), bool), gaps, True)
    doc = np.insert(doc[keep], gaps, np.uint64(0))
    item_marked = np.zeros(len(item), bool)
    covered = tiles = 0
    longest = len(item)
    while True:
        low, high = smallest - 1, longest  # a run of ``low`` exists, none longer than ``high``
        while low < high:
            middle = (low + high + 1) // 2
            a = runs(item, middle)[_free(item_marked, middle)]
            b = runs(doc, middle)[_free(doc_marked, middle)]
            low, high = (middle, high) if np.isin(a, b).any() else (low, middle - 1)
        if low < smallest:
            return covered, tiles
        placed = sum(1 for _ in _placed(item, doc, item_marked, doc_marked, low))
        covered, tiles = covered + placed * low, tiles + placed
        longest = low if placed else low - 1


@dataclass
class _Benchmark:
    """Items and an index of their seeds, held by a task. The words of all items are numbered in a row."""

    ids: list[int]
    codes: list[np.ndarray]

    def __post_init__(self):
        sizes = np.array([len(c) for c in self.codes], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.needed = COVERAGE * sizes
        self.seeds = {}
        for length in range(1, TILE + 1):
            own = [i for i, n in enumerate(sizes) if n and min(n, TILE) == length]
            if own:
                keys = [runs(self.codes[i], length) for i in own]
                place = np.concatenate([np.arange(len(k)) + self.first[i] for i, k in zip(own, keys)])
                keys = np.concatenate(keys)
                order = np.argsort(keys, kind="stable")
                self.seeds[length] = keys[order], place[order]

    def _candidates(self, doc: np.ndarray) -> np.ndarray:
        """Items whose words in seeds that the text holds, too, reach the coverage."""
        words = []
        for length, (keys, place) in self.seeds.items():
            found = np.unique(runs(doc, length))
            at = np.searchsorted(keys, found)
            at[at == len(keys)] = 0
            found = found[keys[at] == found]
            low, high = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
            held = place[np.arange((high - low).sum()) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)]
            words += [held + k for k in range(length)]
        if not words:
            return np.empty(0, np.int64)
        item = np.searchsorted(self.first, np.unique(np.concatenate(words)), "right") - 1
        item, covered = np.unique(item, return_counts=True)
        return item[covered >= self.needed[item]]

    def hits(self, body: bytes) -> list[tuple[int, int, int, int]]:
        """(item, covered, words, tiles) of each item that the text contains."""
        doc = word_codes(body)
        out = []
        for i in self._candidates(doc):
            item = self.codes[i]
            covered, tiles = tile(item, doc, min(TILE, len(item)))
            if covered >= COVERAGE * len(item):
                out.append((self.ids[i], covered, len(item), tiles))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[_Benchmark]:
    """The distinct items in blocks of about BLOCK_BYTES, dealt by a hash; only one is with the driver at a time."""
    items = as_bytes(benchmark, "item_id").distinct()
    size = items.agg(F.sum(F.length("body") + 64)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    items = stored(items.withColumn("block", F.pmod(F.xxhash64("body"), F.lit(blocks)))) if blocks > 1 else items
    for block in range(blocks):
        rows = items if blocks == 1 else items.filter(F.col("block") == block)
        rows = rows.select("doc_id", "body").orderBy("doc_id", "body").collect()
        yield _Benchmark([r.doc_id for r in rows], [word_codes(bytes(r.body)) for r in rows])


_SCHEMA = "doc_id long, item_id long, coverage double, covered_words long, item_words long, tiles long"


def _contaminated_by(docs: DataFrame, known: _Benchmark) -> DataFrame:
    def work(columns):
        out = [[], [], [], [], [], []]
        for doc_id, body in zip(*columns):
            for item, covered, words, tiles in known.hits(body):
                for column, value in zip(out, (doc_id, item, covered / words, covered, words, tiles)):
                    column.append(value)
        return out

    return by_batch(as_bytes(docs), work, _SCHEMA, ["doc_id", "body"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item whose words are covered by tiles to ``COVERAGE`` or more.

    Words are runs of letters, digits and underscores in lower case; an item of one or two words is found where they stand
    together. Items without words are never found; null and empty texts contain nothing. Repeated document rows give
    repeated results, repeated item rows count once; of ties between equally long matches the first in the item, then in
    the document, is marked. Either table may be empty. A large benchmark reads the documents once for each block.
    """
    return reduce(DataFrame.unionByName, [_contaminated_by(docs, known) for known in _blocks(benchmark)])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    at = docs.columns.index(text)

    def without(known: _Benchmark):
        def keep(batches):
            for batch in sliced(batches):
                bodies = batch.column(at).to_pylist()
                yield batch.filter(pa.array([not known.hits((b or "").encode()) for b in bodies], pa.bool_()))

        return keep

    schema = docs.schema
    for known in _blocks(benchmark):
        docs = docs.mapInArrow(without(known), schema)
    return docs


def op10_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
