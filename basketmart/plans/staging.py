"""Typed staging of the source tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.functions.timegrid import hour_of_hhmm
from basketmart.sources.tables import LazyTables


def stage_transactions(raw: DataFrame) -> DataFrame:
    """Typed receipt lines: signed discounts kept, positive discount amounts and the receipt hour added."""

    def amount(name: str):
        return F.abs(F.coalesce(F.col(name).cast("double"), F.lit(0.0)))

    hhmm = F.col("trans_time").try_cast("int")
    return raw.select(
        F.col("household_key").cast("long").alias("household_key"),
        F.col("basket_id").cast("long").alias("basket_id"),
        F.col("day").cast("int").alias("day"),
        F.col("week_no").cast("int").alias("week_no"),
        F.col("product_id").cast("long").alias("product_id"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("sales_value").cast("double").alias("sales_value"),
        F.col("store_id").cast("long").alias("store_id"),
        F.col("retail_disc").cast("double").alias("retail_disc_signed"),
        F.col("coupon_disc").cast("double").alias("coupon_disc_signed"),
        F.col("coupon_match_disc").cast("double").alias("coupon_match_disc_signed"),
        amount("retail_disc").alias("retail_discount_amt"),
        amount("coupon_disc").alias("coupon_discount_amt"),
        amount("coupon_match_disc").alias("coupon_match_discount_amt"),
        hhmm.alias("trans_time"),
        hour_of_hhmm(hhmm).alias("trans_hour"),
    )


# Staged name of each source table; only the receipt lines are reshaped, the other seven pass through as declared.
STAGED_NAMES = {
    "transaction_data": "transactions",
    "product": "products",
    "hh_demographic": "households",
    "campaign_desc": "campaigns",
    "campaign_table": "exposures",
    "coupon": "coupons",
    "coupon_redempt": "redemptions",
    "causal_data": "merchandising",
}


def stage_all(sources: Mapping[str, DataFrame]) -> LazyTables:
    """Staged tables under short names."""

    def staged(name: str):
        return stage_transactions(sources[name]) if name == "transaction_data" else sources[name]

    return LazyTables({short: (lambda name=name: staged(name)) for name, short in STAGED_NAMES.items()})


def register_views(staged: Mapping[str, DataFrame]) -> None:
    """Offer the staged tables to SQL users as ``stg_<name>`` views."""
    for name, frame in staged.items():
        frame.createOrReplaceTempView(f"stg_{name}")
