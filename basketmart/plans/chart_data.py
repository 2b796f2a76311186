"""Tables behind the report figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmart.operators.ordering import quantile_row
from basketmart.plans.categories import CATEGORY, top_categories


def clip_at_quantile(frame: DataFrame, column: str, probability: float) -> DataFrame:
    """Values above the column's own quantile are lowered to it."""
    limit = quantile_row(frame, {"limit": (F.col(column), probability)}).scalar()
    return frame.withColumn(column, F.least(F.col(column), limit))


def histogram(frame: DataFrame, column: str, bins: int, low: Column, high: Column, count_name: str) -> DataFrame:
    """Counts in equal-width bins between two scalars, all ``bins`` of them; the last includes its upper edge."""
    width = (high - low) / bins
    place = F.when(width > 0, F.floor((F.col(column) - low) / width)).otherwise(0)
    counts = (
        frame.filter(F.col(column).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias(count_name))
    )
    every = frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("bin_start"), F.coalesce(count_name, F.lit(0)).cast("long").alias(count_name)
    )


def basket_spend_histogram(baskets: DataFrame) -> DataFrame:
    """Fifty bins of basket spend, clipped at its 99th percentile."""
    spend = baskets.select("basket_spend")
    clipped = clip_at_quantile(spend, "basket_spend", 0.99)
    bounds = clipped.agg(F.min("basket_spend").alias("low"), F.max("basket_spend").alias("high"))
    return histogram(
        clipped, "basket_spend", 50, bounds.select("low").scalar(), bounds.select("high").scalar(), "baskets"
    )


def basket_frequency_histogram(periods: DataFrame) -> DataFrame:
    """Forty bins of baskets per active household period."""
    active = periods.filter(F.col("active_flag") == 1).select("basket_count")
    bounds = active.agg(
        F.min("basket_count").cast("double").alias("low"), F.max("basket_count").cast("double").alias("high")
    )
    return histogram(
        active, "basket_count", 40, bounds.select("low").scalar(), bounds.select("high").scalar(), "household_periods"
    )


def retention_pivot(matrix: DataFrame, last_period: int) -> DataFrame:
    """Cohorts as rows, periods as columns."""
    wide = matrix.groupBy("cohort_period").pivot("period_id", list(range(1, last_period + 1))).max("retention_rate")
    return wide.select("cohort_period", *[F.col(str(p)).alias(f"period_{p}") for p in range(1, last_period + 1)])


def category_points(categories: DataFrame) -> DataFrame:
    """Reach, sales, growth and discount of the forty largest supported categories."""
    return top_categories(categories, "category_sales", 40, 50).select(
        *CATEGORY, "household_penetration", "category_sales", "sales_growth", "discount_rate"
    )


def discount_sales_fit(categories: DataFrame) -> DataFrame:
    """Least-squares line of category sales on discount rate over the same categories."""
    return category_points(categories).agg(
        F.regr_slope("category_sales", "discount_rate").alias("slope"),
        F.regr_intercept("category_sales", "discount_rate").alias("intercept"),
    )


def first_campaigns(campaigns: DataFrame, count: int = 20) -> DataFrame:
    """Reach and redemption of the first campaigns by number."""
    return campaigns.orderBy("campaign").limit(count).select("campaign", "exposed_households", "redeeming_households")
