"""Household × four-week period mart and the tables built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, money, positive_ratio, units
from basketmart.functions.timegrid import DAYS_PER_PERIOD, period_of_day, period_of_week
from basketmart.plans.baskets import basket_discount_units
from basketmart.plans.categories import UNKNOWN, category_labels

KEY = ["household_key", "period_id"]


def _by_household():
    return W.partitionBy("household_key").orderBy("period_id")


def period_series(baskets: DataFrame) -> DataFrame:
    """Periods 1 up to the one of the latest basket."""
    last = baskets.agg(period_of_week(F.max("week_no")).alias("last"))
    return last.select(F.explode(F.sequence(F.lit(1), F.col("last"))).alias("period_id"))


def household_spine(baskets: DataFrame) -> DataFrame:
    """Every household with every period.

    The periods are generated on each household row from one scalar, so no join of the two sets takes place.
    """
    last = baskets.agg(period_of_week(F.max("week_no"))).scalar()
    households = baskets.select("household_key").distinct()
    return households.select("household_key", F.explode(F.sequence(F.lit(1), last)).alias("period_id"))


def _basket_part(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("household_key", period_of_week("week_no").alias("period_id")).agg(
        F.lit(1).alias("active_flag"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("basket_count"),
        F.sum(units("basket_spend")).alias("spend_u"),
        F.sum("basket_units").alias("total_units"),
        F.count("basket_units").alias("sized_baskets"),
        F.sum(basket_discount_units()).alias("discount_u"),
        F.sum("coupon_used_flag").alias("coupon_basket_count"),
    )


def _product_part(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct products and categories; products are made distinct before the join so it sees far fewer rows.

    One of a product's categories, if it is listed under several, stands for it in the count of products. So rows are
    counted per category and then per key, and not copied for two distinct counts.
    """
    bought = tx.select("household_key", period_of_week("week_no").alias("period_id"), "product_id").distinct()
    listed = category_labels(products).select(
        "product_id", F.coalesce("commodity_desc", "department", F.lit(UNKNOWN)).alias("category")
    )
    # a window holds the categories of one product
    place = F.row_number().over(W.partitionBy("product_id").orderBy("category"))
    labelled = bought.join(listed.distinct().withColumn("place", place), "product_id", "left")
    stands = F.col("product_id").isNotNull() & (F.coalesce("place", F.lit(1)) == 1)
    per_category = labelled.groupBy(*KEY, F.coalesce("category", F.lit(UNKNOWN)).alias("category")).agg(
        F.count_if(stands).alias("products")
    )
    return per_category.groupBy(*KEY).agg(
        F.sum("products").alias("distinct_product_count"), F.count(F.lit(1)).alias("distinct_category_count")
    )


def _exposure_part(exposures: DataFrame, campaigns: DataFrame) -> DataFrame:
    dated = exposures.join(campaigns.select("campaign", "start_day"), "campaign")
    return dated.groupBy("household_key", period_of_day("start_day").alias("period_id")).agg(
        F.count(F.lit(1)).alias("campaign_exposure_count")
    )


def _redemption_part(redemptions: DataFrame) -> DataFrame:
    return redemptions.groupBy("household_key", period_of_day("day").alias("period_id")).agg(
        F.count(F.lit(1)).alias("coupon_redemption_count")
    )


_MEASURES = [
    "basket_count",
    "spend_u",
    "total_units",
    "sized_baskets",
    "discount_u",
    "coupon_basket_count",
    "distinct_product_count",
    "distinct_category_count",
    "coupon_redemption_count",
    "campaign_exposure_count",
]


def _combined(parts: list[DataFrame], spine: DataFrame | None = None) -> DataFrame:
    """Put all parts on one row per household and period, dropping rows outside the spine (or without a basket).

    Parts are stacked and aggregated, which needs one shuffle where a chain of joins needs one per side. Shuffling by
    household alone also serves the windows over a household's periods; every part holds at most one row per key.
    """
    if spine is not None:
        parts = [*parts, spine.withColumn("in_spine", F.lit(1))]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    frame = "active_flag" if spine is None else "in_spine"
    combined = (
        stacked.repartition("household_key")
        .groupBy(*KEY)
        .agg(
            *[F.max(name).alias(name) for name in {"active_flag": 0, frame: 0}],
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            *[F.sum(name).alias(name) for name in _MEASURES],
        )
    )
    return combined.filter(F.col(frame) == 1)


def _zero(name: str):
    return F.coalesce(name, F.lit(0)).alias(name)


def _discount_rate():
    return positive_ratio(F.col("discount_u"), F.col("spend_u") + F.col("discount_u")).alias("discount_rate")


def _averages():
    return [
        mean_money(F.col("spend_u"), F.col("basket_count")).alias("average_basket_value"),
        positive_ratio(F.col("total_units"), F.col("sized_baskets")).alias("average_basket_size"),
    ]


def mart_household_period(
    baskets: DataFrame,
    tx: DataFrame,
    products: DataFrame,
    exposures: DataFrame,
    campaigns: DataFrame,
    redemptions: DataFrame,
) -> DataFrame:
    """Complete household × period spine; inactive periods carry zeros, averages and rates there are NULL."""
    parts = [
        _basket_part(baskets),
        _product_part(tx, products),
        _exposure_part(exposures, campaigns),
        _redemption_part(redemptions),
    ]
    last_day = tx.agg(F.max("day")).scalar()
    last_period = baskets.agg(period_of_week(F.max("week_no"))).scalar()
    period = F.col("period_id")
    cut_short = (period == last_period) & (period * DAYS_PER_PERIOD > last_day)
    base = _combined(parts, household_spine(baskets)).select(
        *KEY,
        ((period - 1) * DAYS_PER_PERIOD + 1).alias("period_start"),
        F.least(period * DAYS_PER_PERIOD, last_day).alias("period_end"),
        F.when(cut_short, 1).otherwise(0).alias("incomplete_period_flag"),
        _zero("active_flag"),
        _zero("basket_count"),
        _zero("spend_u"),
        _zero("total_units"),
        *_averages(),
        _zero("discount_u"),
        _zero("coupon_basket_count"),
        _zero("distinct_product_count"),
        _zero("distinct_category_count"),
        _zero("coupon_redemption_count"),
        _zero("campaign_exposure_count"),
        _discount_rate(),
    )
    before = F.lag("spend_u").over(_by_household())
    retained = (F.col("active_flag") == 1) & (F.lag("active_flag").over(_by_household()) == 1)
    return base.select(
        *KEY,
        "period_start",
        "period_end",
        "incomplete_period_flag",
        "active_flag",
        "basket_count",
        money("spend_u").alias("total_spend"),
        "total_units",
        "average_basket_value",
        "average_basket_size",
        money("discount_u").alias("total_discount"),
        "coupon_basket_count",
        "distinct_product_count",
        "distinct_category_count",
        "coupon_redemption_count",
        "campaign_exposure_count",
        "discount_rate",
        money(before).alias("prior_period_spend"),
        money(F.col("spend_u") - before).alias("spend_change"),
        F.when(retained, 1).otherwise(0).alias("retention_repeat_flag"),
    )


def mart_household_period_active(
    baskets: DataFrame,
    tx: DataFrame,
    products: DataFrame,
    exposures: DataFrame,
    campaigns: DataFrame,
    redemptions: DataFrame,
) -> DataFrame:
    """Older convention: active periods only, so "prior" means the previous active period and gaps are ignored."""
    parts = [
        _basket_part(baskets),
        _product_part(tx, products),
        _exposure_part(exposures, campaigns),
        _redemption_part(redemptions),
    ]
    combined = _combined(parts)
    before = F.lag("spend_u").over(_by_household())
    return combined.select(
        *KEY,
        F.col("first_day").alias("period_start_day"),
        F.col("last_day").alias("period_end_day"),
        "active_flag",
        "basket_count",
        money("spend_u").alias("total_spend"),
        "total_units",
        *_averages(),
        money("discount_u").alias("total_discount"),
        "coupon_basket_count",
        "distinct_product_count",
        "distinct_category_count",
        _zero("coupon_redemption_count"),
        _zero("campaign_exposure_count"),
        _discount_rate(),
        money(before).alias("prior_period_spend"),
        money(F.col("spend_u") - before).alias("spend_change"),
        F.when(F.lag("active_flag").over(_by_household()) == 1, 1).otherwise(0).alias("retention_repeat_flag"),
    )


def dropped_events(
    periods: DataFrame, exposures: DataFrame, campaigns: DataFrame, redemptions: DataFrame
) -> DataFrame:
    """Exposures and redemptions the spine does not hold: no basket, or later than the last period. One row each."""
    spine = periods.select(*KEY)
    frames = {
        "campaign_exposures": (_exposure_part(exposures, campaigns), "campaign_exposure_count"),
        "coupon_redemptions": (_redemption_part(redemptions), "coupon_redemption_count"),
    }
    rows = [
        part.join(spine, KEY, "left_anti").agg(F.coalesce(F.sum(count), F.lit(0)).alias("dropped_events")).select(
            F.lit(name).alias("event"), "dropped_events"
        )
        for name, (part, count) in frames.items()
    ]
    return rows[0].unionByName(rows[1])


def with_first_active_period(periods: DataFrame) -> DataFrame:
    """Periods with the household's first active one; a window, so it shares the partitioning by household."""
    active = F.when(F.col("active_flag") == 1, F.col("period_id"))
    return periods.withColumn("first_active_period", F.min(active).over(W.partitionBy("household_key")))


def customer_period_summary(periods: DataFrame) -> DataFrame:
    """Active, new, returning and retained households per period."""
    seen = with_first_active_period(
        periods.select(*KEY, "period_start", "period_end", "active_flag", "retention_repeat_flag")
    ).withColumn("prior_active", F.lag("active_flag").over(_by_household()))
    active = F.col("active_flag") == 1

    def households(condition):
        return F.sum(F.when(condition, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))

    prior = households(F.col("prior_active") == 1)
    retained = F.sum("retention_repeat_flag")
    return seen.groupBy("period_id").agg(
        F.min("period_start").alias("period_start"),
        F.max("period_end").alias("period_end"),
        F.sum("active_flag").alias("active_households"),
        households(active & (F.col("period_id") == F.col("first_active_period"))).alias("new_households"),
        households(active & (F.col("period_id") > F.col("first_active_period"))).alias("returning_households"),
        prior.alias("prior_active_households"),
        retained.alias("retained_households"),
        positive_ratio(retained, prior).alias("retention_rate"),
    )


def customer_retention_matrix(periods: DataFrame) -> DataFrame:
    """Cohort × period retention.

    The spine holds each household once per period, so the rows of a cohort in any period count the whole cohort.
    """
    cohorts = with_first_active_period(periods.select(*KEY, "active_flag")).withColumnRenamed(
        "first_active_period", "cohort_period"
    )
    size, active = F.count(F.lit(1)), F.sum("active_flag")
    return (
        cohorts.filter(F.col("period_id") >= F.col("cohort_period"))
        .groupBy("cohort_period", "period_id")
        .agg(
            active.alias("active_households"),
            size.alias("cohort_households"),
            positive_ratio(active, size).alias("retention_rate"),
        )
    )
