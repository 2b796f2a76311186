"""Quality rules: plain counts, and the divergence of a text from its language.

Two histograms of a text are compared with its language's by Jensen-Shannon distance (base 2, so 0 to 1): character classes,
and the language's most common words with one cell for all others. References are made from all documents of a language. A
histogram is judged only if the text is long enough for it; otherwise it passes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketmart.llm.text import by_batch, read_table
from basketmart.session import stored

# Bytes of each character class; the last class is everything else, UTF-8's longer codes among it.
CLASSES = [
    b"aeiouy",
    b"bcdfghjklmnpqrstvwxz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:!?'\"()-",
    b"#*$%&|<>",
    b" ",
    b"\n",
]
SYMBOLS = b"#*$%&|<>"
COMMON = 100  # words of a reference
LONGEST = 8  # characters of a word that a reference holds where a caller sets no other limit; the query has none
LEAST_WORDS = 2_000  # of a language in all, for it to have a reference
MOST = 1_000  # languages whose references are broadcast at once
EVERY = ""  # the reference for texts without a language
WINDOW = 8
CLASS_CHARS, CLASS_DISTANCE = 200, 0.28  # least characters, largest distance
WORD_WORDS, WORD_DISTANCE = 100, 0.44  # least words, largest distance

_CLASS = np.full(256, len(CLASSES))
for _n, _members in enumerate(CLASSES):
    _CLASS[list(_members)] = _n


def _with_lang(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("body"),
        F.coalesce(F.col("lang").cast("string"), F.lit(EVERY)).alias("lang"),
    )


def class_counts(body: bytes) -> np.ndarray:
    counts = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    return np.bincount(_CLASS, counts, len(CLASSES) + 1)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors; 0 where one of them is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def repeated_words(words: list[bytes]) -> int:
    """Words in runs of eight that the text holds twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        runs = (runs ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(31)
    order = np.argsort(runs, kind="stable")
    equal = runs[order[1:]] == runs[order[:-1]]
    if not equal.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, int)
    edges[:n] += again
    edges[WINDOW:] -= again[: len(words) + 1 - WINDOW]
    return int((np.cumsum(edges)[: len(words)] > 0).sum())


def repeated_lines(body: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    if b"\n" not in body:
        return 0
    lines = [line for line in body.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _fits(word: bytes, longest: int | None) -> bool:
    return longest is None or len(word) <= longest or not word.isascii() and len(word.decode("utf-8", "replace")) <= longest


def _reference_counts(rows: DataFrame, longest: int | None = LONGEST) -> DataFrame:
    """``lang``, ``kind`` (0: class, 1: word, 2: all words), ``item``, ``n``; each text also counts for EVERY. ``longest`` is
    the limit on a word's characters, None for words of any length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = defaultdict(Counter)
            classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES) + 1))
            for body, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[lang].update(body.lower().split())
                classes[lang] += class_counts(body)
            out = [[], [], [], []]
            for lang, counts in words.items():
                held = [(1, w, n) for w, n in counts.items() if _fits(w, longest)]
                cells = [(0, b"%d" % i, int(n)) for i, n in enumerate(classes[lang])]
                for kind, item, n in [*held, *cells, (2, b"", counts.total())]:
                    for column, value in zip(out, (lang, kind, item, n)):
                        column.append(value)
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["lang", "kind", "item", "n"]
            )

    counted = rows.select("body", "lang").mapInArrow(run, "lang string, kind int, item binary, n long")
    return counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


class Reference:
    """Class counts, and common words with their counts, the last for all others."""

    def __init__(self, classes: np.ndarray, words: dict[bytes, int], total: int):
        self.classes = classes
        self.places = {w: i for i, w in enumerate(words)}
        self.words = np.array([*words.values(), max(0, total - sum(words.values()))], float)

    def cells(self, words: list[bytes]) -> np.ndarray:
        get, other = self.places.get, len(self.places)
        return np.bincount([get(w, other) for w in words], minlength=other + 1)


def _languages(counts: DataFrame) -> list[str]:
    """Those with LEAST_WORDS words or more."""
    enough = counts.filter((F.col("kind") == 2) & (F.col("lang") != EVERY) & (F.col("n") >= LEAST_WORDS))
    return [r.lang for r in enough.select("lang").orderBy("lang").collect()]


def references(docs: DataFrame, longest: int | None = LONGEST) -> dict[str, Reference]:
    """One for each language with LEAST_WORDS words or more, and the one for every language together."""
    counts = stored(_reference_counts(_with_lang(docs), longest))
    return _references(counts, _languages(counts))


def _table(spark: SparkSession, groups: list[list[str]]) -> DataFrame:
    """Each language and the number of its group."""
    table = pa.table(
        {
            "of": pa.array([lang for own in groups for lang in own], pa.string()),
            "group": pa.array([i for i, own in enumerate(groups) for _ in own], pa.int32()),
        }
    )
    return spark.createDataFrame(table)


def _references(counts: DataFrame, chosen: list[str]) -> dict[str, Reference]:
    # EVERY is what all languages add up to; it replaces the rows of documents without a language
    every = counts.groupBy("kind", "item").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(EVERY))
    langs = _table(counts.sparkSession, [chosen])
    named = counts.join(F.broadcast(langs), F.col("lang") == F.col("of")).select("kind", "item", "n", "lang")
    both = named.unionByName(every)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
    words = both.filter("kind = 1").withColumn("place", place).filter(F.col("place") <= COMMON)
    rows = both.filter("kind <> 1").unionByName(words.drop("place")).collect()
    out = {}
    for lang in {r.lang for r in rows}:
        own = [r for r in rows if r.lang == lang]
        classes = np.zeros(len(CLASSES) + 1)
        for r in own:
            if r.kind == 0:
                classes[int(r.item)] = r.n
        common = sorted(((r.n, bytes(r.item)) for r in own if r.kind == 1), key=lambda x: (-x[0], x[1]))
        out[lang] = Reference(classes, {w: n for n, w in common}, sum(r.n for r in own if r.kind == 2))
    return out


_MEASURED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def judge_quality(docs: DataFrame, known: dict[str, Reference]) -> DataFrame:
    """The rule counts, both distances and the verdict of each row's whole text.

    Null and empty texts have no words and fail the base rules. Texts of a language without a reference are
    not judged by either histogram, texts without a language are compared with all languages together. Texts below ``CLASS_CHARS`` characters or ``WORD_WORDS`` words are not judged by that
    histogram (distance 0). Repeated rows are judged each; ``lang`` may be null.
    """
    model = docs.sparkSession.sparkContext.broadcast(known)

    def work(columns):
        out = [[] for _ in range(10)]
        for doc_id, body, lang in zip(*columns):
            words = body.split()
            reference = model.value.get(lang)
            text_size = len(body.decode("utf-8", "replace"))
            blanks = len(body) - len(body.translate(None, b" \t\n\v\f\r"))
            symbols = len(body) - len(body.translate(None, SYMBOLS))
            repeats = repeated_words(words)
            failed = len(words) < 20 or 100 * repeats > 30 * len(words)
            by_class = by_word = 0.0
            if reference and text_size >= CLASS_CHARS:
                by_class = distance(class_counts(body), reference.classes)
            if reference and len(words) >= WORD_WORDS:
                by_word = distance(reference.cells(body.lower().split()), reference.words)
            kept = not failed and by_class <= CLASS_DISTANCE and by_word <= WORD_DISTANCE
            row = (doc_id, len(words), text_size - blanks, symbols, repeated_lines(body), repeats, failed, kept)
            for column, value in zip(out, (*row, by_class, by_word)):
                column.append(value)
        return out

    return by_batch(_with_lang(docs), work, _MEASURED, ["doc_id", "body", "lang"])


def judge_by_language(docs: DataFrame, longest: int | None = LONGEST) -> DataFrame:
    """The same with references made from ``docs``; more than MOST languages are judged a group after the other."""
    counts = stored(_reference_counts(_with_lang(docs), longest))
    langs = _languages(counts)
    groups = [langs[i : i + MOST] for i in range(0, len(langs), MOST)]
    if len(groups) < 2:
        return judge_quality(docs, _references(counts, langs))
    rows = docs.select("doc_id", "text", "lang").join(
        F.broadcast(_table(docs.sparkSession, groups)), F.col("lang") == F.col("of"), "left"
    )
    rows = rows.withColumn("group", F.coalesce("group", F.lit(0)))
    out = None
    for i, own in enumerate(groups):
        part = judge_quality(rows.filter(F.col("group") == i), _references(counts, own))
        out = part if out is None else out.unionByName(part)
    return out


def op3_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_by_language(read_table(spark, folder, "documents"), longest=None)
