import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import basketmart.llm.minhash as M
from basketmart.llm.components import components
from basketmart.llm.text import shingles


def brute(rows, size, percent):
    """n_shingles and component of each row, over sets of word tuples."""
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        n = max(1, len(words) - size + 1)
        sets[key] = frozenset(tuple(words[i : i + size]) for i in range(n)) if words else frozenset()
    holders = defaultdict(list)
    for key, own in sets.items():
        for s in own:
            holders[s].append(key)
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for key, own in sets.items():
        for other, common in Counter(e for s in own for e in holders[s] if e < key).items():
            if 100 * common >= percent * (len(own) + len(sets[other]) - common):
                a, b = sorted((find(key), find(other)))
                root[b] = a
    return {key: (len(own), find(key)) for key, own in sets.items()}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_test_table(spark, size, percent):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(M.near_duplicates(docs, size, percent)) == brute(rows, size, percent)


def family(rng, n, words=120, edits=(0, 14)):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(*edits)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_families_of_near_copies_of_all_degrees(spark, monkeypatch):
    """Many rows share buckets without being alike enough, so the blocks have to find links between components."""
    monkeypatch.setattr(M, "BLOCK", 8)
    rng = random.Random(11)
    texts = family(rng, 90) + family(rng, 60, 60, (0, 10)) + [f"only {i} " * 9 for i in range(20)]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(1000, texts[3].upper()), (1001, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(M.near_duplicates(docs, 3, 85)) == brute(rows, 3, 85)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, "a b c d " * 30_000), (8, "a b c d " * 30_000)]
    docs = spark.createDataFrame([(i, t, 0, True) for i, t in rows], "doc_id long, text string, component_id int, kept boolean")
    want = {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (4, 7), 8: (4, 7)}
    got = M.near_duplicates(docs, 3, 85)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == want
    assert {r.doc_id for r in got.filter("kept").collect()} == {1, 2, 3, 4, 6, 7}
    assert M.near_duplicates(docs.limit(0), 3, 85).count() == 0
    repeated = M.near_duplicates(docs.filter("doc_id = 4").union(docs.filter("doc_id = 4")), 3, 85)
    assert [tuple(r) for r in repeated.collect()] == 2 * [(4, 1, 4, True)]


def test_equal_permutations_give_equal_signatures_and_estimates_hold():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 2000).astype(np.uint64))
    b = np.concatenate([a[:1500], np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))])
    assert (M.signature(a) == M.signature(a[::-1].copy())).all()
    agreement = (M.signature(a) == M.signature(b)).mean()
    assert abs(agreement - 0.6) < 0.2


def test_block_returns_joining_links_only():
    words = [f"w{i}" for i in range(50)]
    body = " ".join(words).encode()
    rows = pd.DataFrame({"doc_id": [1, 2, 3, 4], "component": [1, 1, 3, 4], "body": [body, body, body + b" x", b"none of it"]})
    links = M._within_block(rows, 3, 85)
    assert len(links) == 1 and set(links.iloc[0]) & {1, 2} and 3 in set(links.iloc[0])


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 30)] + [(3, 3), (5, 4), (4, 5), (5, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 30)} | {3: 3, 4: 4, 5: 4}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_ordered_and_distinct():
    assert len(shingles(b"a b c a b c".split(), 3)) == 3
    assert set(shingles(b"a b c".split(), 3)).isdisjoint(shingles(b"c b a".split(), 3))
    assert len(shingles([], 3)) == 0


def test_kept_is_one_of_each_component(spark):
    got = M.op6_circulant_minhash(spark, "/root/testdata/sf0.001")
    one = got.groupBy("component_id").agg(F.sum(F.col("kept").cast("int")).alias("n"))
    assert one.filter("n <> 1").count() == 0


WORDS = [f"w{i}" for i in range(60)]
T = " ".join(WORDS)


def test_repeated_and_null_ids_lose_no_link(spark):
    other = "nothing of the kind is said in here"
    rows = [(1, T), (5, other), (5, T + " more"), (None, T), (None, other), (None, "alone with these few words"), (7, None)]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    seen = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got)
    assert seen == sorted(
        [(1, 58, 1, True), (5, 6, 5, True), (5, 59, 1, False), (0, 58, 1, False), (0, 6, 5, False), (0, 3, 0, True), (7, 0, 7, True)]
    )


def test_one_of_each_goes_by_texts(spark):
    rows = [(1, T), (5, T), (5, "a text that only this row has"), (9, ""), (9, ""), (8, None), (None, "no id and said once only")]
    rows += [(3, "said by one id in two rows"), (3, "said by one id in two rows"), (3, "Said by one id in two rows"), (None, T)]
    docs = spark.createDataFrame([(i, t, n, 0) for n, (i, t) in enumerate(rows)], "doc_id long, text string, node long, row_key int")
    got = M.one_of_each(docs)
    assert got.columns == docs.columns
    left = [(r.doc_id or 0, r.text or "") for r in got.collect()]
    assert len({text for i, text in left if i == 3}) == 1
    assert sorted(row for row in left if row[0] != 3) == sorted(
        [(1, T), (5, "a text that only this row has"), (9, ""), (9, ""), (8, ""), (0, "no id and said once only")]
    )
    assert M.one_of_each(docs.limit(0)).count() == 0


def test_long_texts_make_smaller_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_SHINGLES", 200)
    rows = [(i, " ".join(WORDS[:50] + [f"x{i}_{k}" for k in range(i % 7)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(M.near_duplicates(docs, 3, 85)) == brute(rows, 3, 85)
