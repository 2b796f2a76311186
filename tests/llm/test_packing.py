import zlib

import numpy as np
import pytest

from basketmart.llm.packing import Packer, _merge, op9_bounded_packing, pack
from basketmart.llm.wordbpe import word_ids


def check(rows, texts, length=4096):
    """Every id once, sequences gapless and no longer than ``length``; ``texts``: (doc_id, text), ids unique."""
    encode = word_ids().tokenizer.encode
    ids = {k: encode(t or "", add_special_tokens=False).ids + [2] for k, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for key, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[key])
            part = np.array(ids[key][at : at + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
            at += r.length
        assert at == len(ids[key])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_sequence) * length / sum(map(len, ids.values())) - 1


def test_table_is_packed_with_little_padding(spark):
    folder = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert check(op9_bounded_packing(spark, folder).collect(), texts) < 0.03


@pytest.mark.parametrize("length, keep", [(64, 1), (64, 4), (256, 8)])
def test_small_windows(spark, length, keep):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").repartition(3)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check(pack(docs, length=length, keep=keep).collect(), texts, length)


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "a<|endoftext|>B  c"), (4, "Éa " * 20_000), (5, "é" * 9000), (6, "don't 12.5, x\x85y"), (7, "A b")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, start string")
    check(pack(docs).collect(), texts)
    assert pack(docs.limit(0)).count() == 0
    twice = pack(docs.filter("doc_id < 3").union(docs.filter("doc_id < 3"))).collect()
    assert sorted(r.doc_id for r in twice) == [1, 1, 2, 2] and len({(r.sequence_id, r.offset) for r in twice}) == 4


def test_windows_stay_bounded_and_fit_best():
    packer = Packer(100, 2)
    assert packer.place(60) == [(60, 0, 0)]
    assert packer.place(50) == [(50, 1, 0)]
    assert packer.place(40) == [(40, 0, 60)]  # fills the fuller one
    assert packer.place(230) == [(100, 2, 0), (100, 3, 0), (30, 1, 50)]
    assert packer.place(90) == [(90, 4, 0)]
    assert packer.place(95) == [(95, 5, 0)]  # the fullest has a gap below LEAST and is left with it
    assert packer.place(30) == [(30, 6, 0)]
    assert packer.place(90) == [(20, 1, 80), (70, 6, 30)] and len(packer.open) == 0


def test_merge_moves_whole_windows():
    import pandas as pd

    rows = pd.DataFrame(
        [(1, 0, 30, 0, 30, 10, 0), (2, 0, 20, 0, 20, 10, 30), (3, 0, 50, 0, 50, 11, 0), (4, 0, 60, 0, 60, 12, 0)],
        columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )
    got = _merge(rows, 100)
    assert got[["sequence_id", "offset"]].values.tolist() == [[10, 0], [10, 30], [10, 50], [12, 0]]


def test_words_of_letters_go_to_the_merges_as_the_tokenizer_would():
    encoder = word_ids()
    texts = ["Plain WORDS, ünïcode ÀÉÎ é é İstanbul ǅ ﬁne ªº 日本 ² x² don't ß ŉ ſ end.", "<|endoftext|> Kept As It Is", "", "a" * 5000]
    for text, ids in zip(texts * 2, encoder.encode([t.encode() for t in texts]) * 2):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
