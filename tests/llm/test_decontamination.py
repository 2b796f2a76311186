import random
import tracemalloc

import basketmart.llm.decontamination as D


def brute_tile(item, doc, smallest):
    """Greedy string tiling as it is defined: longest unmarked matches first, by place in the item, then the document."""
    im, dm = [False] * len(item), [False] * len(doc)
    covered = tiles = 0
    while True:
        best, found = smallest, []
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not im[i + k] and not dm[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best:
                    found.append((i, j))
        if not found:
            return covered, tiles
        for i, j in found:
            if not any(im[i : i + best]) and not any(dm[j : j + best]):
                im[i : i + best] = dm[j : j + best] = [True] * best
                covered, tiles = covered + best, tiles + 1


def codes(words):
    return D.word_codes(" ".join(words).encode())


def test_tiles_agree_with_the_definition():
    rng = random.Random(2)
    for _ in range(300):
        item = [rng.choice("abcdefg") for _ in range(rng.randrange(0, 25))]
        doc = [rng.choice("abcdefg") for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5 and len(item) > 8:
            doc[5:5] = item[4:] + item[:4]
        assert D.tile(codes(item), codes(doc), 3) == brute_tile(item, doc, 3)


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards boldly make toxic brew for evil queens"


def docs_of(spark, *texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")


def test_passages_are_found_however_they_are_ordered(spark):
    words = ITEM.split()
    reordered = " ".join(words[10:] + ["then"] + words[:10])
    docs = docs_of(
        spark, f"before {ITEM.upper()}, after", f"x {reordered} y", " ".join(words[:9]), "clean words only", None, "",
        ("noise " * 40_000) + ITEM.replace(" ", ",\n"), f"x {reordered} y",
    )
    bench = items(spark, ITEM, "too short item", None, "")
    want = {(0, 0, 1.0), (1, 0, 1.0), (6, 0, 1.0), (7, 0, 1.0)}
    got = D.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id, r.coverage) for r in got.collect()} == want
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [2, 3, 4, 5]


def test_large_benchmarks_go_in_blocks(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    small = sorted(map(tuple, D.contaminated(docs, bench).collect()))
    kept = sorted(r.doc_id for r in D.decontaminate(docs, bench).collect())
    monkeypatch.setattr(D, "BLOCK_BYTES", 4_000)
    assert len(list(D._blocks(bench))) > 2
    assert small and sorted(map(tuple, D.contaminated(docs, bench).collect())) == small
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench).collect()) == kept


def test_query_agrees_with_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    bench = {r.item_id: D.word_codes(r.text.encode()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        doc = D.word_codes((r.text or "").encode())
        for item, words in bench.items():
            covered, _ = D.tile(words, doc, min(D.TILE, len(words)))
            if len(words) and covered >= D.COVERAGE * len(words):
                want.add((r.doc_id, item, covered))
    got = {(r.doc_id, r.item_id, r.covered_words) for r in D.op10_string_tiling(spark, folder).collect()}
    assert got == want and got


def test_empty_tables(spark):
    docs, bench = docs_of(spark, ITEM), items(spark, ITEM)
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.decontaminate(docs, bench.limit(0)).count() == 1


def test_rows_without_ids_in_one_block_and_in_several(spark, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog today"
    rows = [(None, f"see {item} again"), (1, f"see {item} again"), (1, "a clean text of some other words"), (2, None), (None, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item), (8, item)], "item_id long, text string")
    got = []
    for limit in (D.BLOCK_BYTES, 50):
        monkeypatch.setattr(D, "BLOCK_BYTES", limit)
        kept = D.decontaminate(docs, bench)
        assert kept.columns == docs.columns
        got.append([sorted(map(tuple, f.collect()), key=str) for f in (D.contaminated(docs, bench), kept)])
    assert got[0] == got[1] and len(got[0][0]) == 4 and len(got[0][1]) == 3


def test_reordered_small_pieces_and_short_items_are_found(spark):
    words = [f"word{k}" for k in range(40)]
    fours = [words[i : i + 4] for i in range(0, 40, 4)][::-1]
    threes = [words[i : i + 3] for i in range(0, 39, 3)][::-1]
    docs = docs_of(
        spark, " ".join(w for four in fours for w in four), " - ".join(" ".join(t) for t in threes), "Forty two", "forty and two",
        "a single answer", "one two three four", " ".join(words[::-1]),
    )
    bench = items(spark, " ".join(words), "forty two", "answer", "one two three four", " ")
    got = {(r.doc_id, r.item_id, r.covered_words) for r in D.contaminated(docs, bench).collect()}
    assert got == {(0, 0, 40), (1, 0, 39), (2, 1, 2), (4, 2, 1), (5, 3, 4)}


def test_recurring_phrases_take_little_memory_and_agree(spark):
    rng = random.Random(5)
    for _ in range(30):
        phrase = ["a", "b", "c"]
        item = [w for _ in range(6) for w in [*phrase, rng.choice("xyz")]]
        doc = [w for _ in range(15) for w in [*phrase, rng.choice("uvxyz")]]
        assert D.tile(codes(item), codes(doc), 3) == brute_tile(item, doc, 3)
    item = codes([w for k in range(1_600 // 4) for w in ["the", "same", "phrase", f"x{k}"]])
    doc = codes([w for k in range(20_000) for w in ["the", "same", "phrase", f"y{k}"]])
    tracemalloc.start()
    assert D.tile(item, doc) == (1_200, 400)
    assert tracemalloc.get_traced_memory()[1] < 30e6
    tracemalloc.stop()
