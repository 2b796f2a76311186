"""Contract of the reported KPIs, and how many groups of each reach its minimum denominator."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTRACT_SCHEMA = """kpi string, numerator string, denominator string, grain string, time_window string,
minimum_denominator int, source_table string, output_column string"""

# KPI names, their output columns and their minimum denominators (NULL where a KPI is not a rate).
CONTRACT = [
    ("active_household", "households with a basket", None, "household", "total", None, "kpi_summary", "active_households"),
    ("basket", "distinct baskets", None, "basket", "total", None, "kpi_summary", "baskets"),
    ("trip_frequency", "baskets", "active households", "household period", "4 weeks", 30, "mart_household_period", "basket_count"),
    ("basket_size", "units", "baskets", "basket", "total", 1, "mart_baskets", "basket_units"),
    ("spend_net_sales", "net sales", None, "line to period", "any", None, "mart_baskets", "basket_spend"),
    ("gross_sales", "net sales plus all discounts", None, "line to basket", "any", None, "mart_baskets", "gross_sales"),
    ("discount_rate", "all discounts", "gross sales", "basket, category", "any", None, "mart_baskets", "discount_rate"),
    ("coupon_redemption_rate", "redeeming households", "exposed households", "campaign", "campaign", 30, "mart_campaigns", "household_redemption_rate"),
    ("campaign_exposure_rate", "exposed households", "active households", "campaign", "campaign", 30, "mart_campaigns", "exposed_households"),
    ("category_penetration", "buying households", "active households", "category", "total", 50, "mart_categories", "household_penetration"),
    ("repeat_purchase", "households with two baskets", "buying households", "product", "total", 50, "mart_products", "repeat_household_count"),
    ("retention_repeat", "active now and before", "active before", "household period", "adjacent 4 weeks", 30, "mart_household_period", "retention_repeat_flag"),
    ("customer_value", "net sales", None, "household", "observation", None, "mart_customer_features", "monetary_spend"),
    ("customer_value_change", "change in net sales", None, "household period", "4 weeks", None, "mart_household_period", "spend_change"),
    ("high_value_customer", "top quartile by spend", "active households", "household", "observation", None, "mart_customer_features", "monetary_spend"),
    ("at_risk_customer", "declining households", "observed households", "household", "label weeks", None, "mart_customer_features", "next_period_spend_decline_flag"),
    ("category_growth", "later less earlier sales", "earlier sales", "category", "weeks to 52 and after", 50, "mart_categories", "sales_growth"),
]

# What each KPI says, and which rows it leaves out or leaves without a value.
DESCRIBED = {
    "active_household": ("a household counts once it has a basket", "households without baskets"),
    "basket": ("one receipt of one household", "lines without a basket"),
    "trip_frequency": ("how often an active household shops in a period", "none; periods without baskets count as 0"),
    "basket_size": ("how many units a basket holds on average", "household periods without baskets have no value"),
    "spend_net_sales": ("what was paid after every discount", "none"),
    "gross_sales": ("what would have been paid without discounts", "none"),
    "discount_rate": ("the part of gross sales that discounts took off", "no value where gross sales are not positive"),
    "coupon_redemption_rate": ("how many of the households a campaign reached used a coupon", "no value without exposures"),
    "campaign_exposure_rate": ("how many of the active households a campaign reached", "campaigns without a description"),
    "category_penetration": ("how many of the active households buy the category", "products without a label are UNKNOWN"),
    "repeat_purchase": ("how many buyers have the product in two baskets", "products with few buyers are withheld"),
    "retention_repeat": ("how many households active before are active again", "the first period has none before"),
    "customer_value": ("what a household spent while it was observed", "none"),
    "customer_value_change": ("how a household's spend moved from one period to the next", "no value in the first period"),
    "high_value_customer": ("households in the top quarter by spend", "households without baskets"),
    "at_risk_customer": ("households whose spend falls in the label weeks", "label weeks take no part in features"),
    "category_growth": ("how much more of the category was sold later", "categories with few households are withheld"),
}

# Where the denominator of a KPI with a minimum can be counted per group.
SUPPORT = {
    "trip_frequency": ("customer_period_summary", "active_households"),
    "basket_size": ("mart_household_period", "basket_count"),
    "coupon_redemption_rate": ("mart_campaigns", "exposed_households"),
    "campaign_exposure_rate": ("kpi_summary", "active_households"),
    "category_penetration": ("mart_categories", "household_count"),
    "repeat_purchase": ("product_buyers", "households"),
    "category_growth": ("mart_categories", "household_count"),
    "retention_repeat": ("customer_period_summary", "prior_active_households"),
}


def kpi_contract(spark: SparkSession) -> DataFrame:
    """The contract as a table; ``minimum_denominator`` is the rule in words, ``minimum`` its number."""
    texts = spark.createDataFrame([(k, *v) for k, v in DESCRIBED.items()], "kpi string, business_definition string, exclusions_or_nulls string")
    rows = spark.createDataFrame(CONTRACT, CONTRACT_SCHEMA).withColumnRenamed("minimum_denominator", "minimum").join(texts, "kpi")
    rule = F.when(F.col("minimum").isNull(), "no minimum").otherwise(
        F.concat(F.lit("at least "), F.col("minimum").cast("string"), F.lit(" of "), F.coalesce("denominator", F.lit("rows")))
    )
    return rows.select(
        "kpi",
        "business_definition",
        "numerator",
        "denominator",
        "grain",
        "time_window",
        "exclusions_or_nulls",
        rule.alias("minimum_denominator"),
        "minimum",
        "source_table",
        "output_column",
    )


def kpi_support(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Groups that reach a KPI's minimum denominator and groups that must not be reported."""
    minimum = {row[0]: row[5] for row in CONTRACT}
    rows = []
    for kpi, (mart, column) in SUPPORT.items():
        least = minimum[kpi]
        counted = marts[mart].agg(
            F.count_if(F.col(column) >= least).alias("reportable_groups"),
            F.count_if(F.coalesce(column, F.lit(0)) < least).alias("withheld_groups"),
        )
        rows.append(
            counted.select(
                F.lit(kpi).alias("kpi"),
                F.lit(mart).alias("source_mart"),
                F.lit(column).alias("denominator"),
                F.lit(least).alias("minimum"),
                "reportable_groups",
                "withheld_groups",
            )
        )
    return reduce(DataFrame.unionByName, rows)
