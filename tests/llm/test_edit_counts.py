import random

from pyspark.sql import functions as F

from basketmart.llm.edit_counts import CountedText, count_edits, op7_edit_aware_counts
from basketmart.llm.wordbpe import word_ids


def whole(text):
    return len(word_ids().tokenizer.encode(text, add_special_tokens=False).ids)


def test_random_edits_agree_with_encoding_anew():
    rng = random.Random(3)
    alphabet = "ab é,.1'\n\t  sX"
    for size in (0, 1, 40, 600, 5000):
        text = "".join(rng.choice(alphabet) for _ in range(size))
        known = CountedText(text, word_ids())
        for _ in range(60):
            start, length = rng.randrange(len(text) + 2), rng.choice([0, 0, 1, 5, 40, 700])
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 30, 3000])))
            known.edit(start, length, new)
            text = text[:start] + new + text[start + length :]
            assert known.text() == text and known.n_chars == len(text)
            assert known.n_tokens == whole(text)


def test_special_spellings_and_long_words():
    text = "x<|endoftext|>y <|startoftext|> " + "w" * 3000 + " end"
    known = CountedText(text, word_ids())
    assert known.n_tokens == whole(text)
    known.edit(1, 3, "< |")
    assert known.n_tokens == whole(text[:1] + "< |" + text[4:])


def test_an_edit_encodes_only_its_surroundings():
    text = "some words of a text " * 5000
    known = CountedText(text, word_ids())
    before = known.encoded
    known.edit(50_000, 3, "other")
    assert known.encoded - before < 2000


def test_rows(spark):
    schema = "doc_id long, text string, edits array<struct<start:int,length:int,replacement:string>>, n_tokens string"
    rows = [
        (1, None, None, "x"),
        (2, "", [(0, 0, "one two"), (5, 99, None)], "x"),
        (3, "a b", [(None, None, None)], None),
        (3, "a b", [(None, None, None)], None),
        (None, "a", [], None),
    ]
    docs = spark.createDataFrame(rows, schema)
    got = sorted((tuple(r)[:4] for r in count_edits(docs).collect()), key=str)
    want = [(1, 0, 0, 0), (2, 0, 0, 0), (2, 1, 2, 7), (2, 2, whole("one t"), 5), (None, 0, 1, 1)]
    want += 2 * [(3, 0, 2, 3), (3, 1, 2, 3)]
    assert got == sorted(want, key=str)
    assert count_edits(docs.limit(0)).count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op7_edit_aware_counts(spark, folder).orderBy("doc_id", "edit").collect()
    assert len(rows) == 4 * len(texts)
    for doc_id, text in texts.items():
        n = len(text)
        a, b, c = int(n / 3), int(n / 2), int(n * 2 / 3)
        states = [text]
        states.append(text[:a] + "revised " + text[a:])
        states.append(states[-1][:b] + states[-1][b + 20 :])
        states.append(states[-1][:c] + text[c : c + 10][::-1].upper() + states[-1][c + 10 :])
        got = [r for r in rows if r.doc_id == doc_id]
        assert [r.n_tokens for r in got] == [whole(s) for s in states]


def test_counts_of_a_column(spark):
    frame = op7_edit_aware_counts(spark, "/root/testdata/sf0.001")
    assert frame.filter(F.col("n_tokens").isNull()).count() == 0
