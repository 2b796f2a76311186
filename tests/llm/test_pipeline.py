import re

import corpus_pipeline as P
from basketmart.llm.minhash import near_duplicates
from basketmart.llm.pii import redact
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_those_asked_for():
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    assert P.ORACLE_SQL is None


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for _, stage in P.STAGES:
        kept.append(P.stored(stage(spark, kept[-1], FOLDER)))
    ids = [{r.doc_id for r in frame.select("doc_id").collect()} for frame in kept]
    for before, after in zip(ids, ids[1:]):
        assert after <= before
    assert all(frame.columns == COLUMNS and frame.dtypes == docs.dtypes for frame in kept[:-1])
    toxic, single, clean, redacted, pieces = kept[1:]
    # one document of each group of what the first stage kept
    groups = near_duplicates(toxic.select("doc_id", "text")).groupBy("component_id").count()
    assert single.count() == groups.count() and ids[2] == {r.component_id for r in groups.collect()}
    # no benchmark passage is left, and only documents that hold one went
    passages = [re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {" ".join(p) for p in passages}
    for r in single.collect():
        words = " ".join(re.findall(r"\w+", (r.text or "").lower()))
        assert any(p in words for p in held) == (r.doc_id not in ids[3])
    # personal data is replaced, everything else as it was
    before = {r.doc_id: r for r in clean.collect()}
    for r in redacted.collect():
        old = before[r.doc_id]
        assert r.text == redact(old.text) and (r.lang, r.source) == (old.lang, old.source)
        assert r.n_chars == (old.n_chars if r.text == old.text else len(r.text))
    assert ids[4] == ids[5]
    assert P.run(spark, FOLDER).count() == pieces.count()


def test_odd_rows_pass(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3), (None, "x y", None, None, 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = P.run(spark, str(tmp_path))
    assert pieces.agg(F.count("*"), F.sum("length")).first() == (5, 1 + 1 + 3 + 3 + 3)
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert P.run(spark, str(empty)).count() == 0
