"""Basket grain: the basket mart, the KPI row and basket descriptives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, money, positive_ratio, units, wide_sum


def basket_units_table(tx: DataFrame) -> DataFrame:
    """Basket × household aggregates with money still in units, for plans that aggregate further."""
    lines = tx.select(
        "basket_id",
        "household_key",
        "day",
        "week_no",
        "store_id",
        "product_id",
        "quantity",
        units("sales_value").alias("sales_u"),
        units("retail_discount_amt").alias("retail_u"),
        units("coupon_discount_amt").alias("coupon_u"),
        units("coupon_match_discount_amt").alias("match_u"),
    )
    return lines.groupBy("basket_id", "household_key").agg(
        F.min("day").alias("day"),
        F.min("week_no").alias("week_no"),
        F.min("store_id").alias("store_id"),
        F.sum("sales_u").alias("spend_u"),
        F.sum("quantity").alias("basket_units"),
        F.count(F.lit(1)).alias("basket_item_line_count"),
        F.count_distinct("product_id").alias("distinct_product_count"),
        F.sum("retail_u").alias("retail_u"),
        F.sum("coupon_u").alias("coupon_u"),
        F.sum("match_u").alias("match_u"),
        F.sum(F.col("sales_u") + F.col("retail_u") + F.col("coupon_u") + F.col("match_u")).alias("gross_u"),
        F.max(F.when(F.col("coupon_u") + F.col("match_u") > 0, 1).otherwise(0)).alias("coupon_used_flag"),
    )


def mart_baskets(tx: DataFrame, legacy_rate: bool = False) -> DataFrame:
    """One row per basket and household.

    ``legacy_rate`` keeps the older convention: discounts over net sales plus retail discount only, no gross column.
    """
    discount = F.col("retail_u") + F.col("coupon_u") + F.col("match_u")
    base = F.col("spend_u") + F.col("retail_u") if legacy_rate else F.col("gross_u")
    columns = [
        "basket_id",
        "household_key",
        "day",
        "week_no",
        "store_id",
        money("spend_u").alias("basket_spend"),
        "basket_units",
        "basket_item_line_count",
        "distinct_product_count",
        money("retail_u").alias("total_retail_discount"),
        money("coupon_u").alias("total_coupon_discount"),
        money("match_u").alias("total_coupon_match_discount"),
    ]
    if not legacy_rate:
        columns.append(money("gross_u").alias("gross_sales"))
    columns += [positive_ratio(discount, base).alias("discount_rate"), "coupon_used_flag"]
    return basket_units_table(tx).select(*columns)


def basket_discount_units():
    return (
        units("total_retail_discount") + units("total_coupon_discount") + units("total_coupon_match_discount")
    )


def kpi_summary(baskets: DataFrame) -> DataFrame:
    """The headline figures, one row."""
    rows = F.count(F.lit(1))
    spend = wide_sum(units("basket_spend"))
    coupon_baskets = F.sum("coupon_used_flag")
    return baskets.agg(
        F.count_distinct("household_key").alias("active_households"),
        rows.alias("baskets"),
        money(spend).alias("spend"),
        mean_money(spend, rows).alias("avg_basket_value"),
        F.sum("basket_units").alias("units"),
        F.avg("basket_units").alias("avg_basket_size"),
        money(wide_sum(basket_discount_units())).alias("discount_amount"),
        coupon_baskets.alias("coupon_baskets"),
        positive_ratio(coupon_baskets, rows).alias("coupon_basket_rate"),
    )


def distinct_total(tx: DataFrame, column: str):
    """Distinct values of one column over the whole fact, as a scalar: a penetration denominator."""
    return tx.agg(F.count_distinct(column).alias("total")).scalar()


def baskets_by_week(tx: DataFrame) -> DataFrame:
    return tx.groupBy("week_no").agg(F.count_distinct("basket_id").alias("baskets"))
