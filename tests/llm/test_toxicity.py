import random

import pytest

from basketmart.llm.toxicity import AFTER, BEFORE, DICTIONARY_BYTES, _Gain, ToxicityModel, _calibrate, _features, fit_toxicity, op2_toxicity, reject_toxic, score_toxicity


def corpus(spark, n=240, repeat=1):
    rng = random.Random(4)
    plain = ["harbour", "window", "garden", "letter", "morning", "bridge", "yellow", "winter", "paper", "river"]
    nasty = ["blockhead", "vermin", "imbecile"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(plain) + rng.choice(["", "s", "ly", "."]) for _ in range(60)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(nasty)
        docs += [(i, " ".join(words), "k")] * repeat
        labels.append((i, 1, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxic_words_are_learnt_and_found_in_new_texts(spark):
    docs, labels = corpus(spark)
    model = fit_toxicity(docs, labels)
    new = spark.createDataFrame(
        [(1, "a bridge for the imbecile and vermin"), (2, "the yellow garden"), (3, None), (4, ""), (5, "winter " * 50_000 + "imbecile"), (2, "the yellow garden")],
        "doc_id long, text string",
    )
    got = {r.doc_id: r for r in score_toxicity(new, model).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[5].predicted == 1
    assert got[3].score == got[4].score and got[3].predicted == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert score_toxicity(new, model).count() == 6 and score_toxicity(new.limit(0), model).count() == 0
    kept = reject_toxic(new, model)
    assert kept.columns == new.columns and sorted(r.doc_id for r in kept.collect()) == [2, 2, 3, 4]


@pytest.mark.parametrize("condition", ["toxic = 0", "toxic = 1", "toxic > 5", "doc_id is null"])
def test_missing_classes_give_a_constant(spark, condition):
    docs, labels = corpus(spark, 40)
    model = fit_toxicity(docs, labels.filter(condition))
    scores = {r.score for r in score_toxicity(docs, model).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1
    assert fit_toxicity(docs.limit(0), labels).weights[1:] == (0.0, 0.0, 0.0)


def test_calibration_finds_the_slope():
    counted = [((x / 10, 0.0, 0.0), round(100 / (1 + 2.718281828 ** (4 - x))), 100) for x in range(10)]
    bias, slope, *_ = _calibrate(counted, 0.3)
    assert slope > 3 and bias < -1


def test_features_of_texts_without_long_words():
    assert (_features([b"", b"a b c"], b"nothing", b"else") == 0).all()
    assert ToxicityModel(b"", b"", (0.0, 0.0, 0.0, 0.0)).weights[0] == 0


@pytest.mark.parametrize("kind", ["han", "glued", "short"])
def test_texts_without_words_of_usual_length(spark, kind):
    rng = random.Random(6)
    plain, nasty, glue = {
        "han": (["花园", "早晨", "河流", "大桥", "冬天", "黄色", "窗户", "信件"], ["混蛋", "白痴"], ""),
        "glued": (["harbour", "window", "garden", "letter", "morning"], ["blockhead", "imbecile"], "_"),
        "short": (["a", "of", "in", "to", "we", "go", "it"], ["fk u", "kys"], " "),
    }[kind]
    docs, labels = [], []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(6):
                words[rng.randrange(60)] = rng.choice(nasty)
        docs.append((i, glue.join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs, model).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in scored) > 0.9 * len(scored)


def test_the_whole_of_a_full_dictionary_is_searched():
    import zlib

    words = [b"%08x" % zlib.crc32(b"%d" % i) for i in range(12_000)]
    gain = _Gain(b"nothing", b" ".join(words)[:DICTIONARY_BYTES])
    cost = lambda word: len(gain.ordinary(BEFORE + word + AFTER))
    unknown = [b"%08x" % zlib.crc32(b"x%d" % i) for i in range(500)]
    assert max(map(cost, words[:500])) < min(map(cost, unknown))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    scored = op2_toxicity(spark, folder)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = [(r.score, r.toxic) for r in scored.filter("held_out").join(labels, "doc_id").collect()]
    toxic, clean = [s for s, t in rows if t], [s for s, t in rows if not t]
    area = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert area > 0.9
    assert sum(s >= 0.3 for s in toxic) > 0.65 * len(toxic) and sum(s >= 0.3 for s in clean) < 0.05 * len(clean)


def test_gains_are_the_same_after_generations_of_windows(monkeypatch):
    import basketmart.llm.toxicity as T

    words = [b"word%d" % (k % 40) for k in range(400)]
    plain = _Gain(b"word1 word2 word3", b"other words of no harm")
    want = [plain[w] for w in words]
    monkeypatch.setattr(T, "CACHE", 7)
    small = _Gain(b"word1 word2 word3", b"other words of no harm")
    assert [small[w] for w in words] == want
    assert len(small) <= 7 and len(small.old) <= 7


def test_null_texts_are_never_rejected(spark):
    from basketmart.llm.toxicity import ToxicityModel, reject_toxic

    docs = spark.createDataFrame([(1, None), (2, ""), (3, "words")], "doc_id long, text string")
    kept = reject_toxic(docs, ToxicityModel(b"", b"", (9.0, 0.0, 0.0, 0.0))).collect()
    assert [r.doc_id for r in kept] == [1]
