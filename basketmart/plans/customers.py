"""Household value: totals, quartiles and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, money, nonzero_ratio, units, wide_sum
from basketmart.functions.timegrid import LABEL_WEEKS
from basketmart.operators.ordering import ntile, running_total

VALUE_TILES = 4


def household_totals(baskets: DataFrame) -> DataFrame:
    """Spend (in units), baskets and last week of each household."""
    return baskets.groupBy("household_key").agg(
        F.sum(units("basket_spend")).alias("spend_u"),
        F.count(F.lit(1)).alias("baskets"),
        F.max("week_no").alias("last_week"),
    )


def household_quartiles(baskets: DataFrame) -> DataFrame:
    """Households with their value quartile; equal spend is ordered by household key."""
    return ntile(household_totals(baskets), VALUE_TILES, ["spend_u", "household_key"], name="value_quartile")


def household_segments(baskets: DataFrame) -> DataFrame:
    """Households with a segment: top quartile first, then lapsed, then bottom quartile, the rest in the middle."""
    quartiles = household_quartiles(baskets)
    cutoff = quartiles.agg((F.max("last_week") - LABEL_WEEKS).alias("cutoff")).scalar()
    segment = (
        F.when(F.col("value_quartile") == VALUE_TILES, "high_value")
        .when(F.col("last_week") < cutoff, "at_risk_lapsed")
        .when(F.col("value_quartile") == 1, "low_value")
        .otherwise("mid_value")
    )
    return quartiles.withColumn("segment", segment)


def customer_segments(baskets: DataFrame) -> DataFrame:
    """Households, spend and baskets per segment."""
    households = F.count(F.lit(1))
    return household_segments(baskets).groupBy("segment").agg(
        households.alias("households"),
        mean_money(wide_sum("spend_u"), households).alias("avg_spend"),
        F.avg("baskets").alias("avg_baskets"),
    )


def value_concentration(baskets: DataFrame) -> DataFrame:
    """Cumulative share of spend by household, largest first."""
    ranked = running_total(household_totals(baskets), "spend_u", [F.col("spend_u").desc(), "household_key"], name="_cum")
    return ranked.select(
        "household_key",
        money("spend_u").alias("spend"),
        nonzero_ratio(F.col("_cum"), F.col("_cum_of")).alias("cumulative_share"),
    )
