"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection of their token ends.

A text's tokens of either side are two rising lists of byte offsets at which a token ends. The shorter list drives: each of
its ends is sought in the longer one by doubling steps from a guessed place and then by halving, which gives its rank there
and whether it is a common end. Common ends cut both lists into groups; the ranks of a token's first and last byte give the
range of the other side's tokens it overlaps. All texts of a slice are one pair of lists: their totals agree, so the end of
a text is a common end, too.

Token ids are remembered by segment. Segments begin before a blank or line break that stands between two characters other
than white space, and between a letter and a full stop or comma. Neither tokenizer joins across such places: A's pre-tokens
end there, and no entry of either vocabulary has one within, which is checked when the files are loaded. So new segments
are encoded in one row and cut apart again.

How often two ids are linked is counted over all documents. The pairs that hold more than a ``HOT``-th of all links, fewer
than ``HOT``, are looked up in a broadcast, all others by a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import byte_chars, read_table, sliced
from basketmart.session import stored

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
REMEMBERED = 200_000  # segments of a generation; two are kept
LONGEST = 64  # characters of a segment that is remembered; longer ones are encoded each time
BYTES = 4_000_000  # bytes of text aligned at once, or one text
HOT = 65_536

_BREAK = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,])")
_BEFORE = " a"  # what stands before a segment that does not start with a blank, while it is encoded
ROW = 2_000  # segments encoded in one row
_KNOWN: dict[tuple[str, str], "Pair"] = {}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the ids of remembered segments."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b)
        plain = {c: b for b, c in byte_chars().items()}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(plain[c] for c in e) if set(e) <= plain.keys() else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        if any(_BREAK.search(t.decode("utf-8", "replace")) for t in self.bytes_a + self.bytes_b):
            raise ValueError("a vocabulary joins across the start of a word, a line break or the end of a word")
        if len(entries) * len(pieces) >= 1 << 31:
            raise ValueError("pairs of ids do not fit 31 bits")
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.shown_a, self.shown_b = _shown(len(entries), b",|"), _shown(len(pieces), b",;")
        self.ids: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def _encoded(self, segments: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each segment, in one row. Only a row of one segment may end with white space."""
        starts, stops, row, size = [], [], [], 0
        for s in segments:
            if s[0] != " ":
                row.append(_BEFORE)
                size += len(_BEFORE)
            row.append(s)
            starts.append(size)
            size += len(s.encode())
            stops.append(size)
        row = "".join(row)
        sides = []
        for ids, tokens, length in (
            (self.a.encode(row, add_special_tokens=False).ids, self.bytes_a, self.length_a),
            (self.b.encode(row[1:], num_threads=1), self.bytes_b, self.length_b),  # B adds the first blank
        ):
            if b"".join([tokens[i] for i in ids]) != row.encode():  # such a segment has no tokens
                return [(b"", b"")] if len(segments) == 1 else [self._encoded([s])[0] for s in segments]
            ids = np.array(ids, "<i4")
            places = 4 * np.searchsorted(np.cumsum(length[ids]), [starts, stops], "right")
            own = ids.tobytes()
            sides.append([own[i:j] for i, j in zip(*places.tolist())])
        return list(zip(*sides))

    def _learn(self, segments: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Make ``ids`` hold the short ones of these segments; the long ones are returned."""
        if len(self.ids) > REMEMBERED:
            self.old, self.ids = self.ids, {}
        ids, old = self.ids, self.old
        new, alone, long = [], [], {}
        for s in segments:
            if s in ids:
                continue
            if s in old:
                ids[s] = old[s]
            elif len(s) > LONGEST:
                long[s] = self._encoded([s])[0]
            else:
                # a blank at either end, beside the one that starts the segment, could join with its neighbour's
                (alone if s[-1].isspace() or s[1:2].isspace() else new).append(s)
        for at in range(0, len(new), ROW):
            part = new[at : at + ROW]
            ids.update(zip(part, self._encoded(part)))
        for s in alone:
            ids[s] = self._encoded([s])[0]
        return long

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids of both sides as little-endian 32-bit numbers; both empty where the text has no tokens by the contract."""
        if not text:
            return b"", b""
        segments = _BREAK.split(" " + text)
        known = self.ids
        try:
            found = [known[s] for s in segments]
        except KeyError:
            long = self._learn(set(segments))
            found = [self.ids[s] if s in self.ids else long[s] for s in segments]
        a, b = [x for x, _ in found], [x for _, x in found]
        return (b"".join(a), b"".join(b)) if all(a) else (b"", b"")


def _shown(size: int, marks: bytes) -> np.ndarray:
    """Decimal ids, each followed by the first mark, then each followed by the second."""
    return np.array([b"%d%c" % (i, mark) for mark in marks for i in range(size)])


def tokenizers(a: str | None = None, b: str | None = None) -> Pair:
    """The pair of files, kept by the Python worker. Without paths, the installed public files."""
    if a is None or b is None:
        import public_tokenizers

        a, b = a or public_tokenizers.path(FILE_A), b or public_tokenizers.path(FILE_B)
    if (a, b) not in _KNOWN:
        _KNOWN[a, b] = Pair(a, b)
    return _KNOWN[a, b]


def gallop(drive: np.ndarray, search: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``drive`` the first place in the rising ``search`` that is not below it, sought from ``at``.

    The last value of ``search`` is not below any. Steps double away from ``at`` until the place is passed, then the
    bracket is halved; all values go on together, those that have arrived take no more steps.
    """
    low, high = np.full(len(at), -1, np.int64), np.full(len(at), len(search) - 1, np.int64)
    right = search[at] < drive
    low[right], high[~right] = at[right], at[~right]
    for forth in (True, False):
        open_, step = np.flatnonzero(right == forth), 1
        while len(open_):
            probe = at[open_] + (step if forth else -step)
            inside = (probe < len(search)) & (probe >= 0)
            open_, probe = open_[inside], probe[inside]
            below = search[probe] < drive[open_]
            low[open_[below]], high[open_[~below]] = probe[below], probe[~below]
            open_ = open_[below == forth]
            step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = search[middle] < drive[open_]
        low[open_[below]], high[open_[~below]] = middle[below], middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that start at ``first``."""
    return np.arange(counts.sum()) + np.repeat(first - _starts(counts)[:-1], counts)


def overlaps(
    drive: np.ndarray, search: np.ndarray, n_drive: np.ndarray, n_search: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token of the driving side: first token of the other side it overlaps, how many, and whether their ends meet.

    ``drive`` and ``search`` are the ends of several texts in a row, ``n_drive`` and ``n_search`` tokens a text.
    """
    within = np.arange(len(drive)) - np.repeat(_starts(n_drive)[:-1], n_drive)
    guess = np.repeat(_starts(n_search)[:-1], n_drive) + within * np.repeat(n_search, n_drive) // np.repeat(n_drive, n_drive)
    place = gallop(drive, search, guess)
    common = search[place] == drive
    first = np.concatenate([[0], place[:-1] + common[:-1]])
    return first, place - first + 1, common


def _aligned(pair: Pair, found: list[tuple[bytes, bytes]], swap: bool) -> dict[str, np.ndarray | list]:
    """Numbers, distinct links and shown groups of texts whose shorter list is B's if ``swap``, otherwise A's."""
    a = np.frombuffer(b"".join([x for x, _ in found]), "<i4")
    b = np.frombuffer(b"".join([y for _, y in found]), "<i4")
    n_a = np.array([len(x) // 4 for x, _ in found])
    n_b = np.array([len(y) // 4 for _, y in found])
    ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    if swap:
        first, counts, common = overlaps(ends_b, ends_a, n_b, n_a)
        link_b, link_a = np.repeat(b, counts), a[_ranges(first, counts)]
    else:
        first, counts, common = overlaps(ends_a, ends_b, n_a, n_b)
        link_a, link_b = np.repeat(a, counts), b[_ranges(first, counts)]
    n = n_b if swap else n_a
    text = np.repeat(np.arange(len(found)), n)
    n_groups = np.bincount(text[common], minlength=len(found))
    n_links = np.bincount(text, counts, minlength=len(found)).astype(np.int64)
    links = (np.repeat(text, counts) << 31) | (link_a.astype(np.int64) * len(pair.bytes_b) + link_b)
    links, times = np.unique(links, return_counts=True)
    # groups: tokens of A, then those of B, in one row
    driven, other = np.flatnonzero(common) + 1, (first + counts)[common]
    upto_a, upto_b = (other, driven) if swap else (driven, other)
    size_a, size_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[upto_a - 1], last_b[upto_b - 1] = len(pair.bytes_a), len(pair.bytes_b)
    # one width for both sides' shown ids, so that a row of them is one run of bytes
    shown = np.empty(len(a) + len(b), max(pair.shown_a.dtype, pair.shown_b.dtype))
    shown[np.arange(len(a)) + np.repeat(upto_b - size_b, size_a)] = pair.shown_a[a + last_a]
    shown[np.arange(len(b)) + np.repeat(upto_a, size_b)] = pair.shown_b[b + last_b]
    cuts = _starts(n_a + n_b)
    groups = [shown[s:e].tobytes().translate(None, b"\0")[:-1] for s, e in zip(cuts[:-1], cuts[1:])]
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": n_links,
        "groups": groups,
        "pairs": (links & ((1 << 31) - 1)).astype(np.int32),
        "times": times.astype(np.int32),
        "n_pairs": np.bincount(links >> 31, minlength=len(found)),
    }


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of at most BYTES bytes, or of one text."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        own = len(text or "") * 2
        if at > start and size + own > BYTES:
            yield start, at
            start, size = at, 0
        size += own
    if start < len(texts):
        yield start, len(texts)


def align(docs: DataFrame, a: str | None = None, b: str | None = None, digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``pairs``, ``times``.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3`` (with ``digest`` its SHA-256 in hex, so that long texts need not be
    written); ``pairs`` are the distinct linked ids as ``id of A * B's size + id of B``, ``times`` how many links each has.
    ``a`` and ``b`` are paths of the tokenizers' files. A text that is null, empty or not given back byte for byte by both
    sides has no tokens: zeros, an empty string and empty lists. Repeated rows and null ids are rows as others; other
    columns are left behind. Memory is that of one slice of rows, or of one text.
    """
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>"
    )
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def part_of(ids: pa.Array, texts: list[str | None], pair: Pair) -> pa.RecordBatch:
        found = [pair.encode(text or "") for text in texts]
        numbers = {name: np.zeros(len(found), np.int64) for name in [*names, "n_pairs"]}
        groups, order, pairs, times = [""] * len(found), [], [], []
        for swap in (False, True):
            rows = [i for i, (x, y) in enumerate(found) if x and (len(y) < len(x)) == swap]
            if not rows:
                continue
            made = _aligned(pair, [found[i] for i in rows], swap)
            for name in numbers:
                numbers[name][rows] = made[name]
            for i, text in zip(rows, made["groups"]):
                groups[i] = hashlib.sha256(text).hexdigest() if digest else text.decode()
            cuts = np.cumsum(made["n_pairs"])[:-1]
            order += rows
            pairs += np.split(made["pairs"], cuts)
            times += np.split(made["times"], cuts)
        back = np.argsort(order)
        offsets = pa.array(_starts(numbers["n_pairs"]), pa.int32())
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([values[i] for i in back] or [np.empty(0, np.int32)])))
            for values in (pairs, times)
        ]
        columns = [ids, *(pa.array(numbers[name]) for name in names), pa.array(groups, pa.string()), *lists]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "groups", "pairs", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(a, b)
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            for start, end in _parts(texts):
                yield part_of(batch.column(0).slice(start, end - start), texts[start:end], pair)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema
    )


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` (links over all rows) and ``best`` (no pair with the same id of B has more)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, where = np.unique(_flat(batch, "pairs"), return_inverse=True)
            n = np.bincount(where, _flat(batch, "times"), minlength=len(pairs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int32)), pa.array(n)], ["pair", "n"])

    counts = aligned.select("pairs", "times").mapInArrow(sums, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("id_b", F.col("pair") % size_b))
    # at most one row for each id of B, 32,000
    most = counts.groupBy("id_b").agg(F.max("n").alias("most"))
    return stored(counts.join(F.broadcast(most), "id_b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def link_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """For each row's key ``at``: ``n_best`` (links whose pair is best for its id of B) and ``count_sum`` over its links."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") * HOT > F.lit(total)).orderBy("pair").toArrow()  # fewer than HOT rows
    table = [hot.column(i).to_numpy() for i in range(3)]
    known = aligned.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            own, times = _flat(batch, "pairs"), _flat(batch, "times").astype(np.int64)
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            is_hot = pair[place] == own if len(pair) else np.zeros(len(own), bool)
            of = row[is_hot], place[is_hot], times[is_hot]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("at"),
                    _sums(of[0], of[2] * best[of[1]], batch.num_rows),
                    _sums(of[0], of[2] * n[of[1]], batch.num_rows),
                    *(
                        pa.ListArray.from_arrays(
                            pa.array(_starts(np.bincount(row[~is_hot], minlength=batch.num_rows)), pa.int32()),
                            pa.array(values[~is_hot].astype(np.int32)),
                        )
                        for values in (own, times)
                    ),
                ],
                ["at", "n_best", "count_sum", "pairs", "times"],
            )

    looked = stored(
        aligned.select("at", "pairs", "times").mapInArrow(run, "at long, n_best long, count_sum long, pairs array<int>, times array<int>")
    )
    rest = looked.select("at", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "at", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    rest = rest.join(counts, "pair").select(
        "at",
        F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    sums = looked.select("at", "n_best", "count_sum").unionByName(rest)
    return sums.groupBy("at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _sums(row: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """Exact integer sums of ``values`` by row; ``row`` rises."""
    upto = _starts(values)
    return pa.array(np.diff(upto[np.searchsorted(row, np.arange(rows + 1))]), pa.int64())


def aligned_with_counts(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """``align`` by digest, with ``n_best`` and ``count_sum`` from the links of all rows."""
    rows = stored(align(docs, a, b, digest=True).withColumn("at", F.monotonically_increasing_id()))
    counts = pair_counts(rows, len(tokenizers(a, b).bytes_b))
    return rows.drop("pairs", "times").join(link_counts(rows, counts), "at").drop("at")


def op11_galloping_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligned_with_counts(read_table(spark, folder, "documents")).withColumnRenamed("groups", "groups_sha256")
