"""The whole set of marts over staged tables.

Marts are planned on first use. ``keep`` decides what happens to a mart that others read: pass a function that writes
it and returns the table, so the fact behind it is not aggregated again for every reader.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from basketmart.plans import baskets, campaigns, categories, customers, features, household_period, products, promotion
from basketmart.plans.validation import validation_checks
from basketmart.sources.tables import LazyTables

Keep = Callable[[str, DataFrame], DataFrame]

# The tables a run exports.
EXPORTED = [
    "mart_baskets",
    "mart_household_period",
    "mart_products",
    "mart_categories",
    "mart_campaigns",
    "mart_coupon_redemptions",
    "mart_customer_features",
    "mart_promotion_performance",
    "mart_category_period",
    "mart_category_diagnostics",
    "customer_period_summary",
    "customer_retention_matrix",
    "campaign_bias_comparison",
    "campaign_segment_analysis",
    "kpi_summary",
    "validation_checks",
]


def _as_is(name: str, frame: DataFrame) -> DataFrame:
    return frame


def marts(s: Mapping[str, DataFrame], keep: Keep = _as_is) -> LazyTables:
    """Every mart and evidence table by name."""
    tables: LazyTables

    def shared(name: str, build: Callable[[], DataFrame]):
        return lambda: keep(name, build())

    builders = {
        "mart_baskets": shared("mart_baskets", lambda: baskets.mart_baskets(s["transactions"])),
        "mart_household_period": shared(
            "mart_household_period",
            lambda: household_period.mart_household_period(
                tables["mart_baskets"],
                s["transactions"],
                s["products"],
                s["exposures"],
                s["campaigns"],
                s["redemptions"],
            ),
        ),
        "mart_products": shared("mart_products", lambda: products.mart_products(s["transactions"], s["products"])),
        "product_buyers": lambda: products.product_buyers(s["transactions"]),
        "mart_categories": shared(
            "mart_categories", lambda: categories.mart_categories(s["transactions"], s["products"])
        ),
        "mart_category_period": shared(
            "mart_category_period", lambda: categories.mart_category_period(s["transactions"], s["products"])
        ),
        "mart_category_diagnostics": lambda: categories.mart_category_diagnostics(
            tables["mart_categories"], tables["mart_category_period"]
        ),
        "mart_campaigns": lambda: campaigns.mart_campaigns(s["campaigns"], s["exposures"], s["redemptions"]),
        "mart_coupon_redemptions": lambda: campaigns.mart_coupon_redemptions(s["redemptions"], s["campaigns"]),
        "mart_promotion_performance": lambda: promotion.mart_promotion_performance(
            s["transactions"], s["merchandising"]
        ),
        "customer_period_summary": lambda: household_period.customer_period_summary(tables["mart_household_period"]),
        "customer_retention_matrix": lambda: household_period.customer_retention_matrix(
            tables["mart_household_period"]
        ),
        "campaign_bias_comparison": lambda: campaigns.campaign_bias_comparison(
            s["transactions"], s["exposures"], s["campaigns"], s["redemptions"]
        ),
        "campaign_segment_analysis": lambda: campaigns.campaign_segment_analysis(
            customers.household_segments(tables["mart_baskets"]), s["exposures"], s["campaigns"], s["redemptions"]
        ),
        "kpi_summary": lambda: baskets.kpi_summary(tables["mart_baskets"]),
        "mart_customer_features": shared(
            "mart_customer_features",
            lambda: features.mart_customer_features(
                s["transactions"], s["products"], s["exposures"], s["campaigns"], s["households"]
            ),
        ),
        "validation_checks": lambda: validation_checks(s, tables),
    }
    tables = LazyTables(builders)
    return tables
