"""Spelling variants: words one edit apart, found by dense tiles of prefix and suffix lengths.

Two words are one edit apart if their common prefix and common suffix together reach the longer word's length less one.
A tile holds words as two matrices of code points, aligned left and right and padded; going over the columns gives the
common prefix and suffix of every pair of its rows at once.

Tiles are made of buckets only, never of the whole vocabulary. With L the longer word's length, an edit leaves the first
half of L or the last half whole, so words share a bucket of (L, first half) or of (L, last half); a pair belongs to the
first that fits. A bucket with too many words is split by the same rule over the code points it leaves free, until one is
left free, where it has no more words than there are letters. Every pair comes from exactly one bucket.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import as_bytes, read_table, sliced
from basketmart.llm.tiles import sized, streamed
from basketmart.session import stored

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
EVERY = 199  # a run whose checksum this divides loses a code point
KEPT = 200_000  # words a task counts before it hands them on
WIDE = 512  # words of a bucket compared at once
TILE_POINTS = 1 << 21  # code points of a tile's matrix; buckets of longer words are compared in smaller tiles

_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # of bytes whose A-Z are lower-cased: a-z and U+00C0 to U+00FF


def runs(doc_id: int | None, body: bytes) -> list[bytes]:
    """The lower-cased runs of a text, damaged ones included."""
    found = _RUN.findall(body.lower())
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for i in [i for i, run in enumerate(found) if zlib.crc32(run, start) % EVERY == 0]:
        word = found[i].decode()
        at = zlib.crc32(found[i], start) % len(word)
        found[i] = (word[:at] + word[at + 1 :]).encode()
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, its occurrences, for words of at least LEAST_LENGTH code points and LEAST_COUNT occurrences."""

    def of(counted: Counter) -> pa.RecordBatch:
        words = [(w.decode(), n) for w, n in counted.items() if len(w) >= LEAST_LENGTH]
        words = [(w, n) for w, n in words if len(w) >= LEAST_LENGTH]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in sliced(batches):
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                counted.update(runs(doc_id, body.as_py()))
                if len(counted) > KEPT:
                    yield of(counted)
                    counted.clear()
        yield of(counted)

    counts = as_bytes(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def _matrices(words: list[str], lengths: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points aligned left and right; ``pad`` is not a letter."""
    width = int(lengths.max())
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left, right = np.full((len(words), width), pad, "<u4"), np.full((len(words), width), pad, "<u4")
    left[row, column] = points
    right[row, width - np.repeat(lengths, lengths) + column] = points
    return left, right


def _run_lengths(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each pair of rows in how many columns they agree from the first on."""
    same = np.ones((len(one), len(other)), bool)
    total = np.zeros(same.shape, np.int32)
    for c in range(min(one.shape[1], other.shape[1])):
        same &= one[:, c][:, None] == other[:, c][None, :]
        if not same.any():
            break
        total += same
    return total


def near_pairs_of_tile(
    words: list[str], bucket: np.ndarray, total: np.ndarray, left: np.ndarray, right: np.ndarray, below: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of words one edit apart in one bucket; pairs that belong to another bucket are left to it.

    A bucket's pairs have a longer word of ``total`` code points, a common prefix from ``left`` to less than ``below`` and a
    common suffix of at least ``right``.
    """
    lengths = np.array([len(w) for w in words])
    found_a, found_b = [], []
    rows = max(1, min(len(words), TILE_POINTS // int(lengths.max())))
    for i in range(0, len(words), rows):
        one, one_back = _matrices(words[i : i + rows], lengths[i : i + rows], 0)
        for j in range(i, len(words), rows):
            other, other_back = _matrices(words[j : j + rows], lengths[j : j + rows], 1)
            prefix = _run_lengths(one, other)
            suffix = _run_lengths(one_back[:, ::-1], other_back[:, ::-1])
            x, y = slice(i, i + rows), slice(j, j + rows)
            longer = np.maximum(lengths[x][:, None], lengths[y][None, :])
            shorter = np.minimum(lengths[x][:, None], lengths[y][None, :])
            good = (prefix + suffix >= longer - 1) & (longer - shorter <= 1)
            good &= (bucket[x][:, None] == bucket[y][None, :]) & (longer == total[x][:, None])
            good &= (prefix >= left[x][:, None]) & (prefix < below[x][:, None]) & (suffix >= right[x][:, None])
            good &= np.arange(i, i + len(one))[:, None] < np.arange(j, j + len(other))[None, :]
            a, b = np.nonzero(good)
            found_a.append(a + i)
            found_b.append(b + j)
    return np.concatenate(found_a), np.concatenate(found_b)


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of words (``word``, ``n``) one edit apart, once, as ``a``, ``n_a``, ``b``, ``n_b``."""

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        numbers = [rows.column(name).to_numpy() for name in ("bucket", "total", "left", "right", "below")]
        spelled, n = rows.column("word"), rows.column("n")
        a, b = (pa.array(at) for at in near_pairs_of_tile(spelled.to_pylist(), *numbers))
        return pa.RecordBatch.from_arrays(
            [spelled.take(a), n.take(a), spelled.take(b), n.take(b)], ["a", "n_a", "b", "n_b"]
        )

    def child(left: Column, right: Column, below: Column) -> Column:
        return F.struct(left.alias("left"), right.alias("right"), below.alias("below"))

    zero = F.lit(0)
    wide = words.select(
        "word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("total"),
        zero.alias("left"), zero.alias("right"), (F.length("word") + 2).alias("below"),
    )
    found = None
    while wide is not None:  # each round halves the code points left free
        free = F.greatest(F.floor((F.col("total") - F.col("left") - F.col("right")) / 2).cast("int"), F.lit(1))
        first, last = F.col("left") + free, F.col("right") + free
        children = F.array(
            child(first, F.col("right"), F.col("below")), child(F.col("left"), last, F.least(first, F.col("below")))
        )
        rows = wide.withColumn("child", F.explode(children)).select("word", "n", "total", "child.*")
        bucket = F.xxhash64(
            "total", "left", "right", F.expr("substring(word, 1, left)"), F.expr("right(word, right)")
        )
        small, wide = sized(rows.withColumn("bucket", bucket), WIDE)
        pairs = streamed(small, ["bucket"], work, "a string, n_a long, b string, n_b long", WIDE)
        found = pairs if found is None else found.union(pairs)
        wide = None if wide is None else stored(wide)
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form it leads to. Counts grow from form to form, so there are no rings."""
    ways = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = stored(ways.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"))
        if ways.filter("further is not null").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """For each word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, one in EVERY of them robbed of a code point by the
    checksum of ``<doc_id>:<run>`` (a null id: ``:<run>``); those of at least LEAST_LENGTH code points with at least
    LEAST_COUNT occurrences count. ``form`` is the near word with the largest ``n``, the first in code-point order of equal
    ones, if it occurs at least RATIO times as often as the word; ``root`` is where forms end. Null and empty texts have no
    words, repeated rows count each, other columns are left behind, an empty table gives an empty result.
    """
    words = stored(word_counts(docs))
    pairs = stored(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a"))
    )
    # UTF-8 orders as code points do
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    near = stored(both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")))
    rows = words.join(near, "word", "left")
    taken = -F.col("best.minus_n") >= RATIO * F.col("n")
    rows = stored(
        rows.select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("best.minus_n")).alias("form_n"),
        )
    )
    roots = _roots(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_prefix_suffix_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(read_table(spark, folder, "documents"))


def spelling_oracle() -> str:
    """DuckDB SQL by plain means: a checksum table, all pairs of words of like length, edit distance on one-byte letters."""
    letters = "".join(map(chr, range(0xC0, 0x100)))
    # one-byte stand-ins, so that DuckDB's distance over bytes is one over letters
    single = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).islower() and chr(c) != "'")[: len(letters)]
    single += "".join(chr(c) for c in range(1, 1 + len(letters) - len(single)))
    stand_ins = "||".join([f"'{''.join(c for c in single if c > ' ')}'", *(f"chr({ord(c)})" for c in single if c <= " ")])
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"""
WITH RECURSIVE
checks(b, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT b, {step}, k + 1 FROM checks WHERE k < 8
),
checksums AS (SELECT list(c ORDER BY b) AS t FROM checks WHERE k = 8),
found AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')), '{upper}', '{lower}') AS run
    FROM documents
),
bytes AS (
    SELECT doc_id, run, hex(encode(concat(doc_id, ':', run))) AS h FROM (SELECT DISTINCT doc_id, run FROM found)
),
summed AS (
    SELECT doc_id, run, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, [('0x' || h[2 * i - 1 : 2 * i])::BIGINT FOR i IN range(1, len(h) // 2 + 1)]),
        lambda c, b : xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h
    FROM bytes, checksums
),
made AS (
    SELECT CASE WHEN h % {EVERY} = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
    FROM found JOIN summed USING (doc_id, run)
),
words AS (
    SELECT word, count(*) AS n, length(word) AS l, translate(word, '{letters}', {stand_ins}) AS plain
    FROM made WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING count(*) >= {LEAST_COUNT}
),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM words a JOIN words b ON b.l BETWEEN a.l - 1 AND a.l + 1 AND a.word <> b.word
    WHERE levenshtein(a.plain, b.plain) = 1
),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word
),
rows AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN most >= {RATIO} * n THEN other END AS form, CASE WHEN most >= {RATIO} * n THEN most END AS form_n
    FROM words LEFT JOIN best USING (word)
),
ways(word, place, k) AS (
    SELECT word, word, 0 FROM rows
    UNION ALL
    SELECT w.word, r.form, k + 1 FROM ways w JOIN rows r ON r.word = w.place WHERE r.form IS NOT NULL
),
roots AS (SELECT word, arg_max(place, k) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM rows JOIN roots USING (word)
"""
