import csv
import gzip
import random
from pathlib import Path

import pytest
from data import lines
from pyspark.sql import functions as F

from basketmart.plans.baskets import mart_baskets
from basketmart.plans.staging import stage_all
from basketmart.plans.warehouse import EXPORTED
from basketmart.run import run
from basketmart.schemas import SCHEMAS
from basketmart.sources.csv import csv_sources, read_hidden_csv, read_source, resolve_source, source_inventory
from basketmart.sources.sinks import append_rows, export_csv, first_rows, materialize, materialize_bucketed, recover
from basketmart.sources.star import star_sources

SF = "/root/testdata/sf0.001"


def put(folder: Path, name: str, header: str, *rows: str):
    (folder / name).write_text("\n".join([header, *rows]) + "\n")


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    """The adapter's tables as CSV files with upper-case headers, one alias name and no merchandising."""
    folder = tmp_path_factory.mktemp("csv")
    for name, frame in star_sources(spark, SF).items():
        if name == "causal_data":
            continue
        file = "_hhdemographic.csv" if name == "hh_demographic" else f"{name}.csv"
        pandas = frame.toPandas()
        pandas.columns = [c.upper() for c in pandas.columns]
        pandas[pandas.columns[::-1]].to_csv(folder / file, index=False)
    return str(folder)


def test_csv_round_trip_gives_the_same_basket_mart(spark, csv_folder):
    from_csv = stage_all(csv_sources(spark, csv_folder))
    from_star = stage_all(star_sources(spark, SF))
    left, right = mart_baskets(from_csv["transactions"]), mart_baskets(from_star["transactions"])
    assert left.schema == right.schema
    assert left.count() == 1473
    assert left.exceptAll(right).count() == 0


def test_aliases_inventory_and_optional_source(spark, csv_folder):
    assert resolve_source(spark, csv_folder, "hh_demographic").endswith("/_hhdemographic.csv")
    files = {r["source"]: r["file"] for r in source_inventory(spark, csv_folder).collect()}
    assert files["hh_demographic"] == "_hhdemographic.csv" and files["causal_data"] is None
    sources = csv_sources(spark, csv_folder)
    assert sources["causal_data"].count() == 0
    assert sources["causal_data"].schema == SCHEMAS["causal_data"]
    assert sources["hh_demographic"].schema == SCHEMAS["hh_demographic"]


def test_hidden_file_names_are_read_whole_in_ranges(spark, tmp_path, monkeypatch):
    rows = [f"{i},{i % 7}" for i in range(500)]
    put(tmp_path, "_campaigntable.csv", "HOUSEHOLD_KEY,CAMPAIGN", *rows)
    for size in (50, 64, 4096, 1 << 20):
        monkeypatch.setattr("basketmart.sources.csv.RANGE_BYTES", size)
        frame = read_source(spark, resolve_source(spark, str(tmp_path), "campaign_table"), "campaign_table")
        assert sorted(r["household_key"] for r in frame.collect()) == list(range(500))
        assert frame.filter("campaign <> household_key % 7").count() == 0


def test_hidden_folder_is_read_file_by_file(spark, tmp_path):
    folder = tmp_path / "_product.csv"
    folder.mkdir()
    for part in ("a.csv", "b.csv"):
        put(folder, part, "x,y", f"{part},1", f'"{part}, again",')
    rows = {tuple(r) for r in read_hidden_csv(spark, str(folder)).collect()}
    assert rows == {("a.csv", "1"), ("a.csv, again", None), ("b.csv", "1"), ("b.csv, again", None)}


def test_missing_required_sources_are_named(spark, tmp_path):
    put(tmp_path, "product.csv", "PRODUCT_ID", "1")
    with pytest.raises(ValueError, match="transaction_data.*campaign_desc"):
        csv_sources(spark, str(tmp_path))


def test_missing_column_and_bad_value_fail(spark, tmp_path):
    put(tmp_path, "coupon.csv", "COUPON_UPC,PRODUCT_ID", "1,2")
    with pytest.raises(ValueError, match="campaign"):
        read_source(spark, str(tmp_path / "coupon.csv"), "coupon")
    put(tmp_path, "campaign_table.csv", "household_key,CAMPAIGN", "1,x")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_source(spark, str(tmp_path / "campaign_table.csv"), "campaign_table").collect()


def test_extra_and_optional_columns(spark, tmp_path):
    put(tmp_path, "hh_demographic.csv", "NOTE,household_key,AGE_DESC", "hello,4,65+")
    frame = read_source(spark, str(tmp_path / "hh_demographic.csv"), "hh_demographic")
    assert frame.first().asDict() == {"household_key": 4, "age_desc": "65+", "note": "hello"}
    inferred = read_source(spark, str(tmp_path / "hh_demographic.csv"), "hh_demographic", infer_schema=True)
    assert dict(inferred.dtypes)["household_key"] == "int"


def test_export_is_sorted_with_missing_values_last_and_counted(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b"), (None, "a"), (1, None), (1, "z")], "n int, s string").repartition(3)
    assert export_csv(frame, str(tmp_path / "out")) == 4
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    rows = [line for part in parts for line in part.read_text().splitlines() if line != "n,s"]
    assert rows == ["1,z", '1,""' if '1,""' in rows else "1,", "2,b", ",a"]
    assert export_csv(frame, str(tmp_path / "out")) == 4  # a rerun replaces the folder


def test_materialize_append_and_bucket(spark, tmp_path):
    frame = lines(spark, {"week_no": 1}, {"week_no": 2}, {"week_no": 2})
    path = str(tmp_path / "t")
    assert materialize(frame, path, ["week_no"]).count() == 3
    assert materialize(frame, path, ["week_no"]).count() == 3
    assert materialize(frame, path, ["week_no"], mode="append").count() == 6
    assert sorted(p.name for p in (tmp_path / "t").glob("week_no=*")) == ["week_no=1", "week_no=2"]
    assert append_rows(frame, frame.select(*reversed(frame.columns))).count() == 6
    spark.sql("DROP TABLE IF EXISTS bucketed_lines")
    table = materialize_bucketed(frame, "bucketed_lines", 4, ["product_id"])
    plan = table.groupBy("product_id").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_first_rows(spark):
    assert first_rows(spark.range(2).toDF("ID"), 5) == [{"id": 0}, {"id": 1}]
    assert len(first_rows(spark.range(20), 10)) == 10


def test_full_run_exports_every_table(spark, csv_folder, tmp_path):
    counts = {r["table"]: r["rows"] for r in run(spark, csv_folder, str(tmp_path)).collect()}
    assert list(counts) == EXPORTED
    assert counts["mart_baskets"] == 1473 and counts["validation_checks"] == 55
    assert counts["mart_household_period"] == 150 * 26
    assert counts["mart_promotion_performance"] == 1  # no merchandising: nothing is promoted
    names = {p.name for p in (tmp_path / "tables").iterdir()}
    assert {*EXPORTED, "feature_ready_households", "experiment_mde", "kpi_contract"} == names


def test_quoted_line_breaks_at_any_range_border(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [
        [str(i), "".join(rng.choices(['"', "\n", ",", "a", "é", "\r\n"], k=rng.randint(0, 9))), rng.choice(["", "x"])] for i in range(120)
    ]
    with open(tmp_path / "_notes.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([["id", "note", "last"], *rows])
    want = sorted((a, b or None, c or None) for a, b, c in rows)
    for size in (7, 33, 100, 1 << 20):
        monkeypatch.setattr("basketmart.sources.csv.RANGE_BYTES", size)
        frame = read_hidden_csv(spark, str(tmp_path / "_notes.csv")).coalesce(8)
        assert sorted(map(tuple, frame.collect())) == want


def test_gzip_is_one_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("basketmart.sources.csv.RANGE_BYTES", 16)
    with gzip.open(tmp_path / "_t.csv.gz", "wt") as out:
        out.write("a,b\n" + "".join(f"{i},v{i}\n" for i in range(50)))
    frame = read_hidden_csv(spark, str(tmp_path / "_t.csv.gz"))
    assert sorted(int(r.a) for r in frame.collect()) == list(range(50)) and frame.rdd.getNumPartitions() == 1


@pytest.mark.parametrize("row", ["1,2,3", "1"])
@pytest.mark.parametrize("name", ["campaign_table.csv", "_campaign_table.csv"])
def test_rows_with_a_wrong_number_of_fields_fail(spark, tmp_path, name, row):
    put(tmp_path, name, "household_key,CAMPAIGN", "4,5", row)
    with pytest.raises(Exception, match="MALFORMED|fields instead of 2"):
        read_source(spark, str(tmp_path / name), "campaign_table").select("household_key").collect()


def test_quoted_breaks_under_a_plain_name(spark, tmp_path):
    put(tmp_path, "hh_demographic.csv", "household_key,AGE_DESC", '4,"65', '+"')
    frame = read_source(spark, str(tmp_path / "hh_demographic.csv"), "hh_demographic", quoted_breaks=True)
    assert frame.first().asDict() == {"household_key": 4, "age_desc": "65\n+"}
    with pytest.raises(Exception, match="MALFORMED"):
        read_source(spark, str(tmp_path / "hh_demographic.csv"), "hh_demographic").collect()


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    materialize(spark.range(5), path)
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        materialize(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert materialize(spark.range(7), path).count() == 7
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_an_interrupted_swap_is_mended(spark, tmp_path):
    path = tmp_path / "t"
    materialize(spark.range(5), str(path))
    path.rename(tmp_path / "t._replaced")  # as after a stop between the two renames
    assert recover(spark, str(path)) and spark.read.parquet(str(path)).count() == 5
    assert not recover(spark, str(path))
    assert materialize(spark.read.parquet(str(path)).filter("id < 2"), str(path)).count() == 2  # reads what it replaces
