import re
from collections import Counter

from basketmart.llm.quality import EVERY, distance, judge_quality, op3_divergence_rules, references, repeated_lines, repeated_words

import numpy as np


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(marked), failed


def test_counts_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op3_divergence_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_clean_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = op3_divergence_rules(spark, folder).join(labels, "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.6 * len(bad)


def test_repeats():
    assert repeated_words(b"a b c d e f g h".split() * 2) == 16
    assert repeated_words(b"a b c d e f g h i a b c d e f g h".split()) == 16
    assert repeated_words(b"a b c d e f g".split()) == 0
    assert repeated_lines(b"x\n\n\nx\n x\nx") == 2


def test_distance():
    p = np.array([1.0, 0.0])
    assert distance(p, p) == 0 and distance(p, np.array([0.0, 3.0])) == 1
    assert distance(p, np.zeros(2)) == 0


def test_edge_rows(spark):
    long = "the garden is in the north of a town " * 20_000
    rows = [(1, None, None), (2, "", "en"), (3, "few words", "xx"), (4, long, "en"), (4, long, "en"), (5, "#" * 5000 + " a" * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as kept", "2 as n_words")
    known = references(docs)
    assert EVERY in known and "en" in known
    got = {r.doc_id: r for r in judge_quality(docs, known).collect()}
    for key, text, _ in rows:
        assert tuple(got[key])[1:7] == brute(text or "")
    assert got[5].kept is False and got[1].kept is False and got[1].class_distance == 0
    assert judge_quality(docs, known).count() == 6
    assert judge_quality(docs.limit(0), references(docs.limit(0))).count() == 0
    assert judge_quality(docs, references(docs.limit(0))).count() == 6


def test_rare_languages_are_not_judged_by_others(spark, monkeypatch):
    import random

    import basketmart.llm.quality as Q

    rng = random.Random(2)
    english = [f"word{i} is" for i in range(3000)]
    russian = "большой город который сегодня человек дорога маленький вечером".split()
    greek = "δρόμος πόλη σήμερα άνθρωπος".split()

    def text(words, n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = [(i, text(english, 30_000), "en") for i in range(60)]
    rows += [(100 + i, text(russian, 150) + f" {i}", "ru") for i in range(20)] + [(200, text(greek, 150), "el")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = references(docs)
    assert set(known) == {EVERY, "en", "ru"} and "маленький".encode() not in known["ru"].places
    assert "большой".encode() in known["ru"].places
    want = sorted(map(tuple, judge_quality(docs, known).collect()))
    got = {r[0]: r for r in want}
    assert all(got[100 + i][7] for i in range(20)) and got[200][7] and got[200][8] == got[200][9] == 0
    monkeypatch.setattr(Q, "MOST", 1)
    assert sorted(map(tuple, Q.judge_by_language(docs).collect())) == want


def test_the_query_counts_words_of_any_length(spark, tmp_path):
    """Two texts of long words only: one in the language's own words, one in words that nobody else uses."""
    import random

    rng = random.Random(4)
    own = [f"langwierigkeit{chr(97 + i)}" for i in range(20)]
    other = [f"sonderbarkeiten{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rng.choice(own) for _ in range(300)), "de") for i in range(30)]
    rows += [(100, " ".join(rng.choice(other) for _ in range(300)), "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    known = references(docs, longest=None)
    assert all(w.encode() in known["de"].places for w in own) and not references(docs)["de"].places
    got = {r.doc_id: r for r in op3_divergence_rules(spark, str(tmp_path)).collect()}
    assert all(got[i].word_distance < 0.44 for i in range(30))
    assert got[100].word_distance > 0.44 and not got[100].kept
