"""SimHash: fingerprints against a plain count of bits, components against all pairs, wide buckets split."""

import numpy as np
import pytest
import xxhash

from basketmart.llm import simhash
from basketmart.llm.components import components
from basketmart.llm.simhash import close_codes, fingerprint, near_duplicates, op12_simhash_blocks, splits

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def _code(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def _classes(codes, bits):
    """Smallest position reachable, by comparing each code with all."""
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    codes = np.array(codes, np.uint64)
    for i, code in enumerate(codes):
        for j in np.flatnonzero(np.bitwise_count(codes[:i] ^ code) <= bits):
            low, high = sorted((find(i), find(int(j))))
            root[high] = low
    return [find(i) for i in range(len(codes))]


def _expected(rows, size, bits=2):
    codes = [_code(text, size) for _, text in rows]
    classes = _classes(codes, bits)
    names = {}
    for (doc_id, _), c in zip(rows, classes):
        if doc_id is not None:
            names[c] = min(names.get(c, doc_id), doc_id)
    return sorted((str(d), f"{code:016x}", str(names.get(c))) for (d, _), code, c in zip(rows, codes, classes))


def _rows(frame):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in frame.collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert _rows(op12_simhash_blocks(spark, SMALL)) == _expected(rows, 3)


@pytest.mark.parametrize("size", [3, 5])
def test_odd_rows(spark, size):
    long = " ".join(f"w{k % 977}" for k in range(70_000))
    rows = [
        (5, "One two THREE four"), (4, "one\ttwo\nthree  four"), (4, "other text of its own here"), (9, None), (8, ""), (7, " \n"),
        (None, "one two three four"), (None, "no id and alone in this"), (2, "word"), (3, "É é É é"), (11, long),
        (12, long + " end"), (13, "a b"), (13, "a b"),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", code long, fingerprint string")
    assert _rows(near_duplicates(docs, size)) == _expected(rows, size)


def test_tiles_of_shingles_add_up(monkeypatch):
    words = [b"w%d" % (k % 37) for k in range(500)]
    whole = fingerprint(words, 3)
    monkeypatch.setattr(simhash, "TILE", 7)
    assert fingerprint(words, 3) == whole == _code(b" ".join(words).decode(), 3)


@pytest.mark.parametrize("bits, wide", [(2, 256), (2, 16), (1, 16), (3, 64)])
def test_crowded_codes_lose_no_link(spark, monkeypatch, bits, wide):
    """A crowd within few bits of one code makes wide buckets at every level; others are far away."""
    monkeypatch.setattr(simhash, "WIDE", wide)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 63))
    crowd = {centre ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 4), False)) for _ in range(600)}
    dense = {centre ^ (0xFF << 56) ^ k for k in range(0, 700)}
    codes = sorted(crowd | dense | set(rng.integers(0, 1 << 63, 300).tolist()))
    frame = spark.createDataFrame([(simhash._signed(c),) for c in codes], "code long")
    found = {r.node % (1 << 64): r.component % (1 << 64) for r in components(close_codes(frame, bits)).collect()}
    groups, expected = {}, {}
    for code, c in zip(codes, _classes(codes, bits)):
        expected.setdefault(c, set()).add(code)
        groups.setdefault(found.get(code, code), set()).add(code)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_two_blocks_stay_equal():
    rng = np.random.default_rng(4)
    for _ in range(200):
        flips = sum(1 << int(i) for i in rng.choice(64, 2, False))
        assert any(not flips & mask for mask in splits(0, 2))
    assert all(len(splits(m, 2)) == 6 and all(s & m == m for s in splits(m, 2)) for m in splits(0, 2))


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
