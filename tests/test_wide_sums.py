"""Totals beyond what a bigint of ten-thousandths holds."""

from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, money_sum, units, wide_sum, wide_units
from basketmart.operators.ordering import running_total
from basketmart.plans.baskets import kpi_summary, mart_baskets
from basketmart.plans.chart_data import histogram
from basketmart.plans.customers import customer_segments, value_concentration
from basketmart.plans.matrix import nearest_to_first_household
from basketmart.plans.statistics import bootstrap_interval, sample_size_by_lift

HUGE = 4e14


def huge_lines(spark, n=4):
    return spark.createDataFrame(
        [(h, h * 10 + b, 1, 1, 1, HUGE + b, 1.0, 0.0, 0.0, 0.0, 1) for h in range(1, n + 1) for b in range(2)],
        "household_key long, basket_id long, day int, week_no int, product_id long, sales_value double, quantity double, "
        "retail_discount_amt double, coupon_discount_amt double, coupon_match_discount_amt double, store_id long",
    )


def test_sums_pass_the_bigint_limit(spark):
    frame = spark.createDataFrame([(HUGE,), (HUGE,), (HUGE,), (0.25,)], "amount double")
    row = frame.agg(
        money_sum("amount").alias("a"),
        mean_money(wide_sum(units("amount")), F.count(F.lit(1))).alias("b"),
        F.sum(wide_units("amount")).alias("c"),
    ).first()
    assert row.a == 3 * HUGE + 0.25 and abs(row.b - 3e14) < 1 and int(row.c) == 12 * 10**18 + 2500


def test_marts_of_huge_receipts(spark):
    baskets = mart_baskets(huge_lines(spark))
    total = 8 * HUGE + 4
    assert kpi_summary(baskets).first().spend == total
    assert {r.avg_spend for r in customer_segments(baskets).collect()} == {2 * HUGE + 1}
    shares = [round(r.cumulative_share, 12) for r in value_concentration(baskets).orderBy("cumulative_share").collect()]
    assert shares == [0.25, 0.5, 0.75, 1.0]
    assert sample_size_by_lift(baskets).count() == 5


def test_running_total_is_exact(spark):
    rows = spark.range(5).select(F.col("id"), F.lit(9 * 10**18).alias("amount"))
    got = running_total(rows, "amount", ["id"]).orderBy("id").collect()
    assert [int(r.running_total) for r in got] == [(k + 1) * 9 * 10**18 for k in range(5)]


def test_bootstrap_resamples_rows(spark):
    frame = spark.range(2000).select("id", (F.col("id") % 100 * 10_000).alias("u"))
    row = bootstrap_interval(frame, "id", "u", "m").first()
    assert row.lower < 49.5 < row.upper
    assert 0.7 < (row.upper - row.lower) / (4 * 28.87 / 2000**0.5) < 1.3
    one = bootstrap_interval(frame.limit(1), "id", "u", "m").first()
    assert one.lower == one.upper
    huge = spark.range(50).select("id", F.lit(9 * 10**17).alias("u"))
    assert bootstrap_interval(huge, "id", "u", "m").first().lower == 9e13


def test_histograms_have_all_bins(spark):
    frame = spark.createDataFrame([(0.0,), (0.1,), (10.0,), (None,)], "x double")
    rows = histogram(frame, "x", 5, F.lit(0.0), F.lit(10.0), "n").orderBy("bin").collect()
    assert [(r.bin, r.bin_start, r.n) for r in rows] == [(0, 0.0, 2), (1, 2.0, 0), (2, 4.0, 0), (3, 6.0, 0), (4, 8.0, 1)]
    same = histogram(frame.filter("x = 10"), "x", 3, F.lit(10.0), F.lit(10.0), "n").orderBy("bin").collect()
    assert [r.n for r in same] == [1, 0, 0]


def test_nearest_is_searched_among_all_households(spark):
    cells = [(h, c, 10_000 * ((h * 7 + c * 3) % 11 + 1)) for h in range(1, 400) for c in range(6)]
    cells += [(900, c, 10_000 * ((7 + c * 3) % 11 + 1) * 3) for c in range(6)]
    frame = spark.createDataFrame([(h, f"c{c}", u) for h, c, u in cells if h == 1 or (h > 380 and h % 11 != 1)], "household_key long, commodity_desc string, spend_u long")
    row = nearest_to_first_household(frame).first()
    assert (row.household_a, row.household_b) == (1, 900) and abs(row.cosine_similarity - 1) < 1e-12
