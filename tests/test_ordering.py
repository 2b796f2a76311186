import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.operators.ordering import (
    exact_quantiles,
    ntile,
    row_numbers,
    rows_above_quantile,
    running_total,
    sliced,
    tied_ranks,
    value_ranks,
)
from basketmart.session import stored

pytestmark = pytest.mark.usefixtures("many_slices")


def hot_frame(spark, rows=3000, seed=7):
    """A third of the rows in one group and a third with one value."""
    rng = random.Random(seed)
    data = [
        (i, "hot" if i % 3 == 0 else f"g{rng.randrange(40)}", 5 if i % 3 == 1 else rng.randrange(1000))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "id long, grp string, v long").repartition(4)


def test_row_numbers_match_a_single_partition_window(spark):
    frame = hot_frame(spark)
    got = row_numbers(frame, ["v", "id"], name="rn")
    expected = F.row_number().over(W.orderBy("v", "id"))
    assert got.withColumn("want", expected).filter("rn <> want or rn_of <> 3000").count() == 0


def test_grouped_row_numbers_match_a_window(spark):
    got = row_numbers(hot_frame(spark), [F.col("v").desc(), "id"], ["grp"], "rn")
    group = W.partitionBy("grp")
    checked = got.withColumn("want", F.row_number().over(group.orderBy(F.col("v").desc(), "id"))).withColumn(
        "size", F.count("*").over(group)
    )
    assert checked.filter("rn <> want or rn_of <> size").count() == 0


@pytest.mark.parametrize("rows", [1, 3, 4, 5, 6, 7, 8, 1001])
def test_ntile_matches_a_window(spark, rows):
    frame = hot_frame(spark, rows)
    got = ntile(frame, 4, ["v", "id"], name="tile")
    assert got.withColumn("want", F.ntile(4).over(W.orderBy("v", "id"))).filter("tile <> want").count() == 0


def test_grouped_ntile_matches_a_window_with_null_group(spark):
    frame = hot_frame(spark).withColumn("grp", F.when(F.col("grp") != "g1", F.col("grp")))
    got = ntile(frame, 4, ["v", "id"], ["grp"], "tile")
    assert got.count() == 3000
    want = F.ntile(4).over(W.partitionBy("grp").orderBy("v", "id"))
    assert got.withColumn("want", want).filter("tile <> want").count() == 0


def test_running_total_matches_a_window(spark):
    got = running_total(hot_frame(spark), "v", ["v", "id"], ["grp"], "run")
    frame = W.partitionBy("grp").orderBy("v", "id").rowsBetween(W.unboundedPreceding, 0)
    assert got.withColumn("want", F.sum("v").over(frame)).filter("run <> want").count() == 0


def test_value_ranks_average_ties_and_skip_nulls(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (2.0,), (None,), (9.0,)], "x double")
    rows = {r["value"]: (r["rows"], r["below"], r["rank"], r["series_rows"]) for r in value_ranks(frame, {"x": F.col("x")}).collect()}
    assert rows == {1.0: (1, 0, 1.0, 5), 2.0: (3, 1, 3.0, 5), 9.0: (1, 4, 5.0, 5)}


def test_tied_ranks_match_pandas(spark):
    frame = stored(hot_frame(spark).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("v"))))
    odd = F.col("id") % 2 == 1
    got = tied_ranks(frame, "v", {"r": F.lit(True), "odd": odd}).toPandas().sort_values("id")
    assert len(got) == 3000
    assert np.array_equal(got["r"].to_numpy(), got["v"].rank(method="average").to_numpy(), equal_nan=True)
    among = got["v"].where(got["id"] % 2 == 1).rank(method="average")
    assert np.array_equal(got["odd"].to_numpy(), among.to_numpy(), equal_nan=True)


def test_rows_equal_in_all_columns_are_spread_and_ranked(spark):
    """Nine in ten rows are the same: every slice gets its share of them, and ties reach over slices."""
    frame = stored(spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 70).otherwise(33).cast("int").alias("v")))
    rows = sliced(frame.withColumn("_spread", F.monotonically_increasing_id()), ["v", "_spread"])
    sizes = [r["count"] for r in rows.groupBy("_slice").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * 4000
    got = tied_ranks(frame, "v", {"r": F.lit(True)}).toPandas()
    assert np.array_equal(np.sort(got["r"]), np.sort(got["v"].rank(method="average")))
    assert (got["r"] == got["v"].rank(method="average")).all()


def test_tied_ranks_of_few_rows(spark):
    frame = stored(spark.createDataFrame([(1, 5.0), (2, None), (3, 5.0)], "id int, v double"))
    assert {r.id: r.r for r in tied_ranks(frame, "v", {"r": F.lit(True)}).collect()} == {1: 1.5, 2: None, 3: 1.5}
    assert tied_ranks(frame.filter("id > 9"), "v", {"r": F.lit(True)}).count() == 0


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = pd.DataFrame({"a": rng.normal(size=997).round(2), "b": rng.integers(0, 5, 997).astype(float)})
    frame = spark.createDataFrame(values)
    found = exact_quantiles(frame, {"a": F.col("a"), "b": F.col("b")}, [0.0, 0.25, 0.5, 0.99, 1.0]).collect()
    assert len(found) == 10
    for row in found:
        assert row["quantile"] == pytest.approx(np.quantile(values[row["series"]], row["probability"]), abs=1e-12)


def test_rows_above_quantile(spark):
    frame = spark.range(1, 201).select(F.col("id").cast("double").alias("x"))
    row = rows_above_quantile(frame, {"x": F.col("x")}, 0.99).first()
    assert (row["quantile"], row["rows"]) == (pytest.approx(198.01), 2)


def test_no_plan_gathers_all_rows_in_one_task(spark):
    """Only the table of slice offsets may be ordered in a single partition."""
    plan = row_numbers(hot_frame(spark), ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    before_single = plan.split("SinglePartition")
    assert len(before_single) <= 2
    assert "HashAggregate(keys=[_slice" in plan
