"""Household features with future-window labels.

Features see weeks up to ``max(week_no) - 13`` only; labels come from the 13 weeks after that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.functions.money import discount_units, mean_money, money, nonzero_ratio, units
from basketmart.functions.timegrid import LABEL_WEEKS
from basketmart.plans.categories import CATEGORY, UNKNOWN, category_labels
from basketmart.schemas import DEMOGRAPHIC_COLUMNS

HOUSEHOLD = "household_key"
LABELS = ["future_spend", "next_period_active_flag", "next_period_spend_decline_flag"]


def observation_end(tx: DataFrame) -> Column:
    """Last week the features may see, as a scalar."""
    return tx.agg((F.max("week_no") - LABEL_WEEKS).alias("end")).scalar()


def all_null_flag(frame: DataFrame, columns: list[str]) -> Column:
    """1 where every listed column the frame has is NULL, else 0; 1 if it has none of them."""
    present = [F.col(name).isNull() for name in columns if name in frame.columns]
    return reduce(Column.__and__, present).cast("int") if present else F.lit(1)


def _zero():
    return F.lit(0).cast("long")


def observed_products(tx: DataFrame, products: DataFrame, end: Column) -> DataFrame:
    """Observed lines reduced to household × product, with the product's category."""
    half = F.greatest(F.lit(1), F.floor(end / 2))
    sales, discount = units("sales_value"), discount_units()
    coupon = units("coupon_discount_amt") + units("coupon_match_discount_amt")
    reduced = (
        tx.filter(F.col("week_no") <= end)
        .groupBy(HOUSEHOLD, "product_id")
        .agg(
            F.max("week_no").alias("last_week"),
            F.sum(sales).alias("sales_u"),
            F.count("sales_value").alias("priced_lines"),
            F.sum("quantity").alias("units"),
            F.sum(discount).alias("discount_u"),
            F.sum(F.when(coupon > 0, F.lit(1).cast("long")).otherwise(_zero())).alias("coupon_lines"),
            F.sum(F.when(F.col("week_no") <= half, sales).otherwise(_zero())).alias("first_u"),
            F.sum(F.when(F.col("week_no") > half, sales).otherwise(_zero())).alias("second_u"),
        )
    )
    # a product listed more than once repeats its lines, as in any join, but is still one product
    listing = W.partitionBy("product_id").orderBy(*CATEGORY)
    listed = category_labels(products).withColumn("copy", F.row_number().over(listing))
    return (
        reduced.join(listed, "product_id", "left")
        .withColumns({name: F.coalesce(name, F.lit(UNKNOWN)) for name in CATEGORY})
        .withColumn("is_new_product", F.col("product_id").isNotNull() & (F.coalesce("copy", F.lit(1)) == 1))
    )


def top_departments(observed: DataFrame) -> DataFrame:
    """Department a household spends most on, ties going to the first name, and the spend on it in units."""
    spend = observed.groupBy(HOUSEHOLD, CATEGORY[0]).agg(F.sum("sales_u").alias("department_u"))
    # the smallest struct is the largest spend, then the first department; unknown spend comes last
    rank = F.struct(
        F.col("department_u").isNull().alias("unknown"),
        (-F.col("department_u")).alias("negative"),
        F.col(CATEGORY[0]).alias("department"),
        F.col("department_u").alias("top_u"),
    )
    best = spend.groupBy(HOUSEHOLD).agg(F.min(rank).alias("best"))
    return best.select(HOUSEHOLD, F.col("best.department").alias("top_department"), "best.top_u")


def _visits(tx: DataFrame, end: Column) -> DataFrame:
    """Baskets before and after the observation end, and the later spend, from one pass over the fact."""
    observed = F.col("week_no") <= end
    per_basket = tx.groupBy(HOUSEHOLD, "basket_id").agg(
        F.max(observed.cast("int")).alias("before"),
        F.max((~observed).cast("int")).alias("after"),
        F.sum(F.when(~observed, units("sales_value"))).alias("future_u"),
    )
    known = F.col("basket_id").isNotNull()
    return per_basket.groupBy(HOUSEHOLD).agg(
        F.sum(F.when(known, F.col("before"))).alias("frequency_baskets"),
        F.sum(F.when(known, F.col("after"))).alias("future_baskets"),
        F.sum("future_u").alias("future_u"),
    )


def mart_customer_features(
    tx: DataFrame, products: DataFrame, exposures: DataFrame, campaigns: DataFrame, demographics: DataFrame
) -> DataFrame:
    """One row per household seen in the observation window."""
    end = observation_end(tx)
    observed = observed_products(tx, products, end)
    base = observed.groupBy(HOUSEHOLD).agg(
        (end - F.max("last_week")).alias("recency_weeks"),
        F.sum("sales_u").alias("sales_u"),
        F.sum("priced_lines").alias("priced_lines"),
        F.sum("units").alias("total_units"),
        F.count_if("is_new_product").alias("product_diversity"),
        F.count_distinct("commodity_desc").alias("category_diversity"),
        F.sum("discount_u").alias("discount_u"),
        F.sum("coupon_lines").alias("coupon_line_count"),
        F.sum("first_u").alias("first_u"),
        F.sum("second_u").alias("second_u"),
    )
    started = campaigns.filter(F.col("start_day") <= end * 7).select("campaign")
    exposed = exposures.join(started, "campaign").groupBy(HOUSEHOLD).agg(F.count(F.lit(1)).alias("exposure_count"))
    joined = (
        base.join(top_departments(observed), HOUSEHOLD, "left")
        .join(_visits(tx, end), HOUSEHOLD, "left")
        .join(exposed, HOUSEHOLD, "left")
        .join(demographics, HOUSEHOLD, "left")
    )
    present = [name for name in demographics.columns if name != HOUSEHOLD]
    spend, future = F.col("sales_u"), F.coalesce("future_u", _zero())
    # weekly pace of the observation window, scaled to the label window; kept as a product to stay exact
    slower = future * end < spend * LABEL_WEEKS
    return joined.select(
        HOUSEHOLD,
        "recency_weeks",
        F.coalesce("frequency_baskets", F.lit(0)).alias("frequency_baskets"),
        money(spend).alias("monetary_spend"),
        mean_money(spend, F.col("priced_lines")).alias("avg_line_sales"),
        "total_units",
        "product_diversity",
        "category_diversity",
        money("discount_u").alias("discount_amount"),
        "coupon_line_count",
        money("first_u").alias("first_half_spend"),
        money("second_u").alias("second_half_spend"),
        nonzero_ratio(F.col("top_u"), spend).alias("top_department_share"),
        money(F.col("second_u") - F.col("first_u")).alias("spend_trend_change"),
        nonzero_ratio(F.col("discount_u"), spend + F.col("discount_u")).alias("discount_rate"),
        nonzero_ratio(F.col("coupon_line_count"), F.col("frequency_baskets")).alias("coupon_engagement"),
        F.coalesce("exposure_count", F.lit(0)).alias("campaign_exposure_count"),
        money(future).alias("future_spend"),
        F.when(F.col("future_baskets") > 0, 1).otherwise(0).alias("next_period_active_flag"),
        F.when((end != 0) & slower, 1).otherwise(0).alias("next_period_spend_decline_flag"),
        *present,
        all_null_flag(demographics, DEMOGRAPHIC_COLUMNS).alias("missing_demographic_flag"),
    )
