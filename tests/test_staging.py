import pytest
from data import dicts, lines, staged
from pyspark.sql import functions as F

from basketmart.functions.money import money, units
from basketmart.functions.timegrid import period_of_day, period_of_week, quarter_of_week
from basketmart.plans.staging import register_views, stage_transactions


def test_discounts_become_positive_and_null_becomes_zero(spark):
    tx = stage_transactions(lines(spark, {"retail_disc": -1.5, "coupon_disc": None, "coupon_match_disc": -0.25}))
    row = tx.first()
    assert (row.retail_disc_signed, row.coupon_disc_signed, row.coupon_match_disc_signed) == (-1.5, None, -0.25)
    assert (row.retail_discount_amt, row.coupon_discount_amt, row.coupon_match_discount_amt) == (1.5, 0.0, 0.25)
    assert len(tx.columns) == 16


@pytest.mark.parametrize(
    "clock, hour",
    [("0000", 0), ("0930", 9), ("2359", 23), ("0960", None), ("2400", None), ("abc", None), (None, None), ("-5", None)],
)
def test_hour_needs_a_valid_clock(spark, clock, hour):
    assert stage_transactions(lines(spark, {"trans_time": clock})).first().trans_hour == hour


def test_period_arithmetic(spark):
    frame = spark.createDataFrame([(1,), (4,), (5,), (13,), (14,), (28,), (29,)], "n int")
    rows = frame.select("n", period_of_week("n"), period_of_day("n"), quarter_of_week("n")).collect()
    assert [tuple(r) for r in rows] == [
        (1, 1, 1, 1),
        (4, 1, 1, 1),
        (5, 2, 1, 1),
        (13, 4, 1, 1),
        (14, 4, 1, 2),
        (28, 7, 1, 3),
        (29, 8, 2, 3),
    ]


def test_money_units_are_exact_for_cents(spark):
    frame = spark.range(200_000).select((F.col("id") / 100 - 500).alias("x"))
    wrong = frame.filter(units("x") != (F.col("id") - 50_000) * 100)
    assert wrong.count() == 0
    assert frame.agg(money(F.sum(units("x")))).first()[0] == sum(range(200_000)) / 100 - 500 * 200_000


def test_views_are_registered(spark):
    register_views(staged(spark, [{}]))
    assert spark.sql("SELECT count(*) FROM stg_transactions").first()[0] == 1
    assert dicts(spark.sql("SELECT product_id FROM stg_products")) == []
