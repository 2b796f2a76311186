"""Galloping alignment: against whole-text tokenization and a plain overlap of byte ranges, hot and rare pairs alike."""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from basketmart.llm import alignment
from basketmart.llm.alignment import align, aligned_with_counts, gallop, op11_galloping_alignment
from basketmart.llm.text import byte_chars
SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string"


def _tokens(texts):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = {c: b for b, c in byte_chars().items()}
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        made_a = [bytes(plain[c] for c in a.id_to_token(i)) for i in ids_a]
        made_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        good = text and b"".join(made_a) == whole and b"".join(made_b) == whole
        yield (list(zip(ids_a, made_a)), list(zip(ids_b, made_b))) if good else ([], [])


def _brute(rows):
    """Every contract column by stepping through the bytes."""
    found = []
    for (doc_id, _), (a, b) in zip(rows, _tokens([text for _, text in rows])):
        ends_a, ends_b = (list(np.cumsum([len(x) for _, x in side])) if side else [] for side in (a, b))
        owner_b = [j for j, (_, x) in enumerate(b) for _ in x]
        links, at = [], 0
        for i, (token, x) in enumerate(a):
            links += [(token, b[j][0]) for j in sorted(set(owner_b[at : at + len(x)]))]
            at += len(x)
        common, held = sorted(set(ends_a) & set(ends_b)), ({}, {})
        for side, tokens, ends in zip(held, (a, b), (ends_a, ends_b)):
            for (token, _), end in zip(tokens, ends):
                side.setdefault(common[bisect_left(common, end)], []).append(str(token))
        groups = [",".join(held[0][cut]) + "|" + ",".join(held[1][cut]) for cut in common]
        text = ";".join(groups)
        found.append((doc_id, len(a), len(b), len(groups), links, text))
    counts = Counter(link for row in found for link in row[4])
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return sorted(
        (
            str(doc_id), n_a, n_b, n_groups, len(links),
            sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )
        for doc_id, n_a, n_b, n_groups, links, text in found
    )


def _rows(frame):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    hashes = "groups_sha256" if "groups_sha256" in frame.columns else "groups"
    return sorted((str(r["doc_id"]), *(r[n] for n in names), r[hashes]) for r in frame.collect())


ODD = [
    (1, "plain words, said twice: plain words"),
    (2, None),
    (3, ""),
    (4, "  two  blanks \t tab\nline\r\n\n end "),
    (5, "▁ is written as a blank by B"),
    (6, "<|endoftext|> and <s> </s> <0x41> <unk>"),
    (7, "Ünïcode é é    x 　 日本語 العربية 🙂 \x00 \x1c \x85 end"),
    (7, "plain words, said twice: plain words"),
    (None, "a row without an id"),
    (8, "x" * 3000 + " " + "word " * 3000),
    (9, " "),
    (10, "a"),
]


@pytest.mark.parametrize("hot", [1, 40, 65_536])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT", hot)
    docs = spark.createDataFrame(ODD, SCHEMA)
    assert _rows(aligned_with_counts(docs)) == _brute(ODD)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert _rows(op11_galloping_alignment(spark, SMALL)) == _brute(rows)


def test_gallop_finds_first_not_below():
    rng = np.random.default_rng(5)
    for n, m in ((1, 1), (5, 900), (300, 300), (40, 41)):
        search = np.unique(rng.integers(0, 5000, m))
        drive = np.unique(np.minimum(rng.integers(0, 5000, n), search[-1]))
        for at in (np.zeros(len(drive), int), rng.integers(0, len(search), len(drive)), np.full(len(drive), len(search) - 1)):
            assert (gallop(drive, search, at) == np.searchsorted(search, drive)).all()


def test_groups_as_text_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "naïve words", 5, "x")], "doc_id long, text string, n_a long, groups string")
    row = align(docs).first()
    a, b = next(_tokens(["naïve words"]))
    sides = [part.split("|") for part in row.groups.split(";")]
    assert [int(i) for x, _ in sides for i in x.split(",")] == [i for i, _ in a]
    assert [int(i) for _, x in sides for i in x.split(",")] == [i for i, _ in b]
    assert row.n_a == len(a) and sum(row.times) == row.n_links


def test_remembered_generations_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    pair = alignment.Pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = [" ".join(f"w{k % 7}x{k % 5}" for k in range(s, s + 9)) for s in range(12)]
    for text, (a, b) in zip(texts * 2, list(_tokens(texts)) * 2):
        x, y = pair.encode(text)
        assert np.frombuffer(x, "<i4").tolist() == [i for i, _ in a]
        assert np.frombuffer(y, "<i4").tolist() == [i for i, _ in b]


def test_empty_table(spark):
    assert aligned_with_counts(spark.createDataFrame([], SCHEMA)).count() == 0
