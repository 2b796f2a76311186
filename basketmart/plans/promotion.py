"""In-store promotion evidence at product-store-week grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, money, units, wide_sum

GRAIN = ["product_id", "store_id", "week_no"]


def product_store_weeks(tx: DataFrame) -> DataFrame:
    """The fact reduced to product-store-week."""
    return tx.groupBy(*GRAIN).agg(
        F.sum(units("sales_value")).alias("sales_u"),
        F.sum("quantity").alias("units"),
        F.count_distinct("basket_id").alias("baskets"),
        F.count(F.lit(1)).alias("transaction_lines"),
    )


def exact_merchandising(merchandising: DataFrame) -> DataFrame:
    """Merchandising collapsed to one row per product-store-week; a flag is up if any duplicate has it up."""

    def shown(name: str):
        return F.max(F.when(F.coalesce(name, F.lit("0")) != "0", 1).otherwise(0)).alias(f"{name}_flag")

    return merchandising.groupBy(*GRAIN).agg(shown("display"), shown("mailer"))


def promoted_product_store_weeks(tx: DataFrame, merchandising: DataFrame) -> DataFrame:
    """Both sides aggregated to the same keys, then joined: no fan-out, and no shuffle for the join itself."""
    joined = product_store_weeks(tx).join(exact_merchandising(merchandising), GRAIN, "left")
    promoted = (F.col("display_flag") == 1) | (F.col("mailer_flag") == 1)
    return joined.withColumn("promotion_status", F.when(promoted, "promoted").otherwise("not_promoted"))


def mart_promotion_performance(tx: DataFrame, merchandising: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    sales = wide_sum("sales_u")
    return promoted_product_store_weeks(tx, merchandising).groupBy("promotion_status").agg(
        rows.alias("product_store_weeks"),
        F.sum("transaction_lines").alias("transaction_lines"),
        money(sales).alias("sales"),
        F.sum("units").alias("units"),
        F.sum("baskets").alias("basket_occurrences"),
        mean_money(sales, rows).alias("avg_sales_per_product_store_week"),
    )
