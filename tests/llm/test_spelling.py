"""Spelling variants: words, near pairs and forms against plain loops; wide buckets and long words lose no pair."""

import random
import re
import zlib
from collections import Counter

import pytest

from basketmart.llm import spelling
from basketmart.llm.spelling import near_pairs, op13_prefix_suffix_tiles, spelling_variants

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]


def _near(words):
    letters = sorted(set("".join(words)))
    return {w: {e for e in _edits(w, letters) if e in words and e != w} for w in words}


def _brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = _near(words)
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            forms[w] = best

    def root(w):
        return root(forms[w]) if w in forms else w

    return sorted((w, str(forms.get(w)), root(w), n, len(near[w]), words.get(forms.get(w), -1)) for w, n in words.items())


def _rows(frame):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in frame.collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert _rows(op13_prefix_suffix_tiles(spark, SMALL)) == _brute(rows)


def test_odd_rows(spark):
    chain = " ".join(["strasse"] * 5 + ["strassen"] * 30 + ["STRASSEN, strassens"] * 200)
    rows = [
        (1, chain), (1, chain), (None, "naïveté " * 9), (3, None), (4, ""), (5, "ÀÉÎõü÷× " * 40 + "àÉÎõü÷× " * 6),
        (6, "x" * 9000 + " "), (6, ("y" * 7000 + "z ") * 7), (7, ("y" * 7001 + " ") * 50), (8, "one-two_three4four " * 20),
        (9, "Ŝtrange letters end runs ŝtrange " * 8),
    ]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA + ", n long, word string")
    assert _rows(spelling_variants(docs)) == _brute(rows)


@pytest.mark.parametrize("wide", [512, 40])
def test_wide_buckets_lose_no_pair(spark, monkeypatch, wide):
    """Few letters, so that halves of words are shared by hundreds."""
    monkeypatch.setattr(spelling, "WIDE", wide)
    rng = random.Random(11)
    words = {"".join(rng.choices("abc", k=rng.randint(6, 8))) for _ in range(1500)}
    words |= {"prefix" + "".join(rng.choices("abcdé", k=5)) for _ in range(800)}
    words |= {"".join(rng.choices("abcdé", k=4)) + "suffixes" for _ in range(500)}
    frame = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    found = Counter(frozenset((r.a, r.b)) for r in near_pairs(frame).collect())
    expected = {frozenset((w, x)) for w, near in _near(words).items() for x in near}
    assert set(found) == expected and set(found.values()) == {1}


def test_small_tiles_and_full_counters(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_POINTS", 30)
    monkeypatch.setattr(spelling, "KEPT", 3)
    rows = [(k, "houses horses house horse hoarse hourse mouses mouse " * (k + 2)) for k in range(6)]
    assert _rows(spelling_variants(spark.createDataFrame(rows, SCHEMA))) == _brute(rows)


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
