import math
import zlib
from collections import Counter

import numpy as np
import pytest

import basketmart.llm.suffix_tree as S


def brute_tree(texts):
    """States and distributions from the definition, with dictionaries."""
    depth = S.DEPTH
    counts = Counter()
    total = 0
    for text in texts:
        padded = b"\n" * depth + text
        total += len(text)
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                counts[padded[i - d : i], padded[i]] += 1
    successors = {}
    for (context, symbol), n in counts.items():
        successors.setdefault(context, {})[symbol] = n
    states = {}

    def shorter(context, symbol, scoring=False):
        """Probability by the longest state shorter than the context."""
        for k in range(1, len(context) + 1):
            s = context[k:]
            if s in states:
                return probability(s, symbol, scoring)
        raise AssertionError

    def probability(s, symbol, scoring=False):
        """Entries below a tenth of the least share build the tree but are left out of it afterwards."""
        known, weight, rare = states[s]
        if symbol in known and not (scoring and symbol in rare):
            return known[symbol]
        return weight * shorter(s, symbol, scoring) if s else weight

    root = {a: (n + 1 / 256) / (total + 1) for a, n in successors.get(b"", {}).items()}
    states[b""] = (root, 1 / 256 / (total + 1), set())
    for d in range(1, depth + 1):
        found = {}
        for context, own in successors.items():
            n = sum(own.values())
            if len(context) != d or n < max(2, S.LEAST_SHARE * total):
                continue
            below = {a: shorter(context, a) for a in own}
            if sum(c * math.log(c / n / below[a]) for a, c in own.items()) >= S.GAIN:
                prior = S.PRIOR * len(own)
                known = {a: (c + prior * below[a]) / (n + prior) for a, c in own.items()}
                rare = {a for a, c in own.items() if c < S.LEAST_SHARE * total / 10}
                found[context] = (known, prior / (n + prior), rare)
        states.update(found)

    def score(text):
        padded, out = b"\n" * depth + text, 0.0
        for i in range(depth, len(padded)):
            for d in range(depth, -1, -1):
                if padded[i - d : i] in states:
                    out += math.log10(probability(padded[i - d : i], padded[i], True))
                    break
        return out

    return score


def normal(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 2500")
    return docs, {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("share", [1e-6, 2e-3])
def test_scores_agree_with_the_definition(spark, small, monkeypatch, share):
    monkeypatch.setattr(S, "LEAST_SHARE", share)
    docs, texts = small
    training = docs.filter("doc_id % 3 <> 0")
    score = brute_tree([normal(t) for k, t in texts.items() if k % 3])
    for r in S.score_texts(docs, training).collect():
        assert math.isclose(r.score, score(normal(texts[r.doc_id])), rel_tol=1e-6)


@pytest.mark.parametrize("share", [1e-6, 2e-3, 2.0])
def test_base_agrees_with_word_counts(spark, small, monkeypatch, share):
    monkeypatch.setattr(S, "LEAST_SHARE", share)
    docs, texts = small
    known = Counter()
    for k, t in texts.items():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            known.update([*(t or "").encode().lower().split(), b"\n"])
    n, v = known.total(), len(known)
    from basketmart.llm.text import held_out

    for r in S.score_texts(docs, docs.filter(~held_out(7))).collect():
        words = [*(texts[r.doc_id] or "").encode().lower().split(), b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in known for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((known[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "A b", None), (4, "A b", None), (5, "é" * 50_000, "x"), (None, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in S.score_texts(docs, docs.filter("doc_id < 5")).collect()}
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1 and got[4].n_known == 3
    assert got[1].train_tokens == 3 + 6 and got[1].score == got[2].score
    assert all(r.score < 0 and math.isfinite(r.score) for r in got.values())
    assert S.score_texts(docs, docs).count() == 7
    nothing = {r.doc_id: r for r in S.score_texts(docs, docs.limit(0)).collect()}
    assert nothing[4].base_score == 0 and math.isclose(nothing[4].score, 4 * math.log10(1 / 256), rel_tol=1e-9)
    assert S.score_texts(docs.limit(0), docs).count() == 0


def test_distributions_sum_to_at_most_one(spark, small):
    docs, _ = small
    levels, _ = S._tree(S._counted(S.as_bytes(docs)).filter("kind = 1"))
    for context in (b"\n\n\n\n\n", b" the ", b"zzzzz", b"tion "):
        code = int.from_bytes(context, "big") << 8
        grams = np.array([code | a for a in range(256)], np.int64)
        total = (10 ** S._log_probability(grams, levels)).sum()
        assert total <= 1 + 1e-9


@pytest.mark.parametrize("share, looked_up", [(0.0, 0), (2e-3, 300)])
def test_joined_grams_and_words_score_as_those_looked_up(spark, small, monkeypatch, share, looked_up):
    monkeypatch.setattr(S, "LEAST_SHARE", share)
    monkeypatch.setattr(S, "LOOKED_UP", looked_up)
    monkeypatch.setattr(S, "FREQUENT_SHARE", 2.0)
    docs, texts = small
    score = brute_tree([normal(t) for k, t in texts.items() if k % 3])
    known = Counter(w for k, t in texts.items() if k % 3 for w in [*(t or "").encode().lower().split(), b"\n"])
    n, v = known.total(), len(known)
    for r in S.score_texts(docs, docs.filter("doc_id % 3 <> 0")).collect():
        words = [*(texts[r.doc_id] or "").encode().lower().split(), b"\n"]
        assert math.isclose(r.score, score(normal(texts[r.doc_id])), rel_tol=1e-6)
        assert r.n_known == sum(w in known for w in words)
        assert math.isclose(r.base_score, sum(math.log10((known[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)


def test_rare_contexts_are_states_however_large_the_corpus(spark):
    """Ten occurrences among 15 million positions, less than a millionth."""
    docs = spark.createDataFrame([(0, "ab " * 5_000_000)] + [(k, "qzxj kvw") for k in range(1, 11)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in S.score_texts(docs.filter("doc_id = 1"), docs).collect()}
    assert got[1] > -1  # nine symbols; by their share alone each would have about -6
