"""Language-model scores by a probabilistic suffix tree over bytes.

A text is its words in ASCII lower case, a space between them and a line feed at the end; its symbols are the bytes. States
are contexts of up to ``DEPTH`` bytes. A context becomes a state if it occurs at least ``LEAST`` times and if its next-symbol
distribution diverges from its suffix's: count times Kullback-Leibler divergence is at least ``GAIN`` nats. None of these
limits depends on the size of the corpus, and a state keeps all its successors; only where ``LEAST_SHARE`` is set above 0 are
contexts below that share of all positions left out, and successors below a tenth of it taken for unseen. A state's
distribution is smoothed towards its suffix's with the weight of its different successors. A symbol is scored by the
longest state that is a suffix of what precedes it. Counts cover all training texts.

The tree grows with the corpus and is a stored table for each depth. The ``LOOKED_UP`` most frequent grams, contexts with a
successor, are looked up within the tasks; all others are resolved once each by joins with the tree and then joined.

The unigram base uses word counts. Words with a share of ``FREQUENT_SHARE`` or more (at most a million) are looked up within
the tasks; all others are joined. Words are told apart by 64-bit fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import as_bytes, held_out, read_table
from basketmart.session import stored

DEPTH = 5
LEAST = 2  # occurrences of a state
LEAST_SHARE = 0.0  # of all positions, for a state; 0 leaves out none
GAIN = 10.0
PRIOR = 1.0  # weight of the suffix's distribution for each different symbol seen after a context
LOOKED_UP = 4_000_000  # grams at most that every task holds, 16 bytes each
FREQUENT_SHARE = 1e-6  # of all training tokens, for words that every task holds
CHUNK = 4_000_000  # bytes of text handled at once
END = b"\n"


def _mask(n: int) -> int:
    return (1 << 8 * n) - 1


def _grams(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of each text, DEPTH symbols before it and itself as one number; and the text's position."""
    joined = [END * DEPTH + b" ".join(own) + END for own in words]
    codes = []
    for text in joined:
        b = np.frombuffer(text, np.uint8).astype(np.uint64)
        n = len(b) - DEPTH
        code = np.zeros(n, np.uint64)
        for k in range(DEPTH + 1):
            code = (code << np.uint64(8)) | b[k : k + n]
        codes.append(code)
    return np.concatenate(codes), np.repeat(np.arange(len(codes), dtype=np.uint64), [len(c) for c in codes])


def _chunks(bodies: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about CHUNK bytes in all, below 65,536 of them, with the position of the first."""
    first = size = 0
    for i, body in enumerate(bodies):
        size += len(body) + 1
        if size >= CHUNK or i - first >= 60_000:
            yield first, bodies[first : i + 1]
            first, size = i + 1, 0
    if first < len(bodies):
        yield first, bodies[first:]


def _word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _counted(rows: DataFrame) -> DataFrame:
    """``kind`` 0: words, 1: grams; ``code``, ``n``: sums of what each chunk of a task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, bodies in _chunks(batch.column(0).to_pylist()):
                words = [body.lower().split() for body in bodies]
                own, n = np.unique(_word_codes([w for text in words for w in [*text, END]]), return_counts=True)
                grams, m = np.unique(_grams(words)[0].view(np.int64), return_counts=True)
                for kind, code, count in ((0, own, n), (1, grams, m)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), kind, np.int32)), pa.array(code), pa.array(count.astype(np.int64))],
                        ["kind", "code", "n"],
                    )

    return rows.select("body").mapInArrow(run, "kind int, code long, n long").groupBy("kind", "code").agg(
        F.sum("n").alias("n")
    )


def _columns(frame: DataFrame, *names: str) -> list[np.ndarray]:
    """Columns of a frame of bounded size, by the first one's order."""
    table = frame.select(*names).toArrow()
    arrays = [table.column(name).to_numpy() for name in names]
    order = np.argsort(arrays[0], kind="stable")
    return [a[order] for a in arrays]


def _tree(grams: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], int]:
    """For each depth two tables: ``code, n, p`` of the grams seen with a context of that length, ``p`` being given by the
    longest state, and ``context, w`` of the states with the log10 weight of the shorter context. Also the positions."""
    total = grams.agg(F.sum("n")).first()[0] or 0
    least = LEAST_SHARE * total
    spark = grams.sparkSession
    roots = _columns(grams.groupBy(F.col("code").bitwiseAND(_mask(1)).alias("code")).agg(F.sum("n").alias("n")), "code", "n")
    share = (roots[1] + 1 / 256) / (total + 1)
    above = spark.createDataFrame(
        [(int(c), int(n), float(p)) for c, n, p in zip(*roots, share)], "code long, n long, p double"
    )
    levels = [(above, spark.createDataFrame([(0, -math.log10(256 * (total + 1)))], "context long, w double"))]
    for depth in range(1, DEPTH + 1):
        code = F.col("code").bitwiseAND(_mask(depth + 1))
        entries = grams.groupBy(code.alias("code")).agg(F.sum("n").alias("n"))
        entries = entries.withColumn("context", F.shiftrightunsigned("code", 8))
        contexts = entries.groupBy("context").agg(F.sum("n").alias("all"), (F.count("*") * PRIOR).alias("prior"))
        contexts = contexts.filter(F.col("all") >= max(float(LEAST), least))
        entries = entries.join(contexts, "context").withColumn("suffix", F.col("code").bitwiseAND(_mask(depth)))
        shorter = above.select(F.col("code").alias("suffix"), F.col("p").alias("shorter"))
        entries = stored(entries.join(shorter, "suffix").select("code", "context", "n", "all", "prior", "shorter"))
        ratio = F.col("n") / F.col("all")
        gain = F.sum(F.col("n") * F.log(ratio / F.col("shorter")))
        states = entries.groupBy("context", "all", "prior").agg(gain.alias("gain")).filter(F.col("gain") >= GAIN)
        weight = F.log10(F.col("prior") / (F.col("all") + F.col("prior")))
        states = stored(states.select("context", weight.alias("w")))
        smooth = (F.col("n") + F.col("prior") * F.col("shorter")) / (F.col("all") + F.col("prior"))
        own = entries.join(states, "context", "left")
        above = stored(own.select("code", "n", F.when(F.col("w").isNotNull(), smooth).otherwise(F.col("shorter")).alias("p")))
        # successors that are left out build the tree, but score as unseen ones
        levels.append((above.filter(F.col("n") >= least / 10), states))
    return levels, total


def _resolved(codes: DataFrame, levels: list) -> DataFrame:
    """``code, value``: log10 probability of the last symbol of each distinct gram, by the longest state.

    From the longest context down: a gram that was seen has its value, for others the weight of a state on the way is added.
    """
    found, left = [], codes.select("code", F.lit(0.0).alias("value"))
    for depth in range(DEPTH, 0, -1):
        seen, states = levels[depth]
        suffix, context = F.col("code").bitwiseAND(_mask(depth + 1)), F.shiftright("code", 8).bitwiseAND(_mask(depth))
        tried = stored(
            left.withColumn("suffix", suffix).join(seen.select(F.col("code").alias("suffix"), "p"), "suffix", "left")
        )
        found.append(tried.filter("p is not null").select("code", (F.col("value") + F.log10("p")).alias("value")))
        unseen = tried.filter("p is null").withColumn("context", context).join(states, "context", "left")
        left = unseen.select("code", (F.col("value") + F.coalesce("w", F.lit(0.0))).alias("value"))
    roots, (weight,) = F.broadcast(levels[0][0]), levels[0][1].collect()  # at most 256 rows, and one
    last = left.withColumn("suffix", F.col("code").bitwiseAND(_mask(1))).join(
        roots.select(F.col("code").alias("suffix"), "p"), "suffix", "left"
    )
    found.append(last.select("code", (F.col("value") + F.coalesce(F.log10("p"), F.lit(weight.w))).alias("value")))
    return reduce(DataFrame.unionByName, found)


def _log_probability(grams: np.ndarray, levels: list) -> np.ndarray:
    """log10 probabilities of an array of grams, in its order."""
    distinct, place = np.unique(grams, return_inverse=True)
    spark = levels[0][0].sparkSession
    return _columns(_resolved(spark.createDataFrame([(int(c),) for c in distinct], "code long"), levels), "code", "value")[1][place]


def _looked_up(levels: list) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent grams and their values, at most LOOKED_UP: those from the least power of two on that allows it."""
    seen = levels[DEPTH][0]
    sizes = seen.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("rows")).collect()
    rows, power = 0, 64
    for size in sorted(sizes, reverse=True):
        if (rows := rows + size["rows"]) > LOOKED_UP:
            break
        power = size["power"]
    return tuple(_columns(seen.filter(F.floor(F.log2("n")) >= power).select("code", F.log10("p").alias("value")), "code", "value"))


def _scores(
    bodies_words: list[list[bytes]], known: np.ndarray, logs: np.ndarray
) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For each text: what the grams that are looked up give to its score, the other grams and how often it holds each."""
    grams, owner = _grams(bodies_words)
    packed = np.sort((grams << np.uint64(16)) | owner)  # equal grams together, with the text's number below
    owner = (packed & np.uint64(0xFFFF)).astype(np.int64)
    grams = (packed >> np.uint64(16)).view(np.int64)
    start = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    values, hit = np.zeros(len(start)), np.zeros(len(start), bool)
    if len(known):
        at = np.minimum(np.searchsorted(known, grams[start]), len(known) - 1)
        hit = known[at] == grams[start]
        values[hit] = logs[at[hit]]
    times = np.diff(np.append(start, len(grams)))
    score = np.bincount(owner, np.repeat(values, times), len(bodies_words))
    missed, often = np.unique(packed[np.repeat(~hit, times)], return_counts=True)
    of = (missed & np.uint64(0xFFFF)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=len(bodies_words)))[:-1]
    other = (missed >> np.uint64(16)).view(np.int64)
    return score, np.split(other[order], ends), np.split(often[order], ends)


_SCORED = (
    "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, "
    "rare array<long>, times array<long>, grams array<long>, gram_times array<long>"
)


def _scored(
    rows: DataFrame, looked_up: tuple[np.ndarray, np.ndarray], frequent: tuple[np.ndarray, np.ndarray], floor: float
) -> DataFrame:
    """What frequent grams give to the score and frequent words to the base; ``rare`` and ``times``: the other words,
    ``grams`` and ``gram_times``: the other grams."""
    model = rows.sparkSession.sparkContext.broadcast((looked_up, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looked_up, (known, counts) = model.value
        logs = np.log10(counts + 1.0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, bodies in _chunks(batch.column(1).to_pylist()):
                words = [body.lower().split() for body in bodies]
                score, grams, gram_times = _scores(words, *looked_up)
                out = [[], [], [], [], [], score.tolist(), [], [], grams, gram_times]
                for i, text in enumerate(words):
                    codes, times = np.unique(_word_codes([*text, END]), return_counts=True)
                    at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
                    hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                    base = (times[hit] * logs[at[hit]]).sum() + floor * times.sum()
                    values = (row, ids[first + i], len(text) + 1, int(times[hit].sum()), float(base))
                    for column, value in zip(out, values):
                        column.append(value)
                    out[6].append(codes[~hit])
                    out[7].append(times[~hit])
                    row += 1
                kinds = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.list_(pa.int64())] * 4
                names = [part.split()[0] for part in _SCORED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return rows.select("doc_id", "body").mapInArrow(run, _SCORED)


def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """For each row of ``docs``: ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Null and empty texts are the end token alone. Repeated rows are scored, and counted in training, each. Without training
    rows nothing is known, the base is 0 for every token and the tree gives every byte 1/256. Rows without an id are kept.
    """
    counts = stored(_counted(as_bytes(training)))
    words, grams = counts.filter("kind = 0"), counts.filter("kind = 1")
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = _columns(words.filter(F.col("n") >= max(1.0, FREQUENT_SHARE * tokens)), "code", "n")
    levels, _ = _tree(grams)
    scored = stored(_scored(as_bytes(docs), _looked_up(levels), tuple(frequent), -math.log10(tokens + kinds + 1)))

    def pairs(codes: str, times: str) -> DataFrame:
        each = scored.select("row", F.explode(F.arrays_zip(codes, times)).alias("w"))
        return each.select("row", F.col(f"w.{codes}").alias("code"), F.col(f"w.{times}").alias("times"))

    rare = words.filter(F.col("n") < max(1.0, FREQUENT_SHARE * tokens)).select("code", "n")
    seen = pairs("rare", "times").join(rare, "code").select(
        "row", F.col("times").alias("more"), (F.col("times") * F.log10(F.col("n") + 1)).alias("gain")
    )
    others = scored.select(F.explode("grams").alias("code")).distinct()
    scores = pairs("grams", "gram_times").join(stored(_resolved(others, levels)), "code").select(
        "row", (F.col("times") * F.col("value")).alias("rest")
    )
    more = seen.unionByName(scores, allowMissingColumns=True).groupBy("row").agg(
        *[F.sum(name).alias(name) for name in ("more", "gain", "rest")]
    )
    return scored.drop("rare", "times", "grams", "gram_times").join(more, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )


def op5_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    scored = score_texts(docs, docs.filter(~held_out(7)))
    return scored.select(
        "doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
