"""Category grain: department plus commodity."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import discount_units, money, nonzero_ratio, positive_ratio, units, wide_sum, wide_units
from basketmart.functions.timegrid import WEEKS_PER_YEAR, quarter_of_week
from basketmart.operators.ordering import quantile_row
from basketmart.plans.baskets import distinct_total
from basketmart.session import stored

CATEGORY = ["department", "commodity_desc"]
SMALL_GROUP_HOUSEHOLDS = 50
UNKNOWN = "UNKNOWN"
NUMBER = "_category"


def category_labels(products: DataFrame) -> DataFrame:
    """Product id with its category columns only, so a join carries no other attribute."""
    return products.select("product_id", *CATEGORY)


def labelled_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their category, ``UNKNOWN`` where the product or the label is missing.

    The join strategy is left to the size of the product table as Spark measures it: broadcast below the threshold,
    otherwise a sort-merge join whose skewed keys adaptive execution splits.
    """
    return lines.join(category_labels(products), "product_id", "left").withColumns(
        {name: F.coalesce(name, F.lit(UNKNOWN)) for name in CATEGORY}
    )


def numbered_categories(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product id with the number of its category, and every category with its number; 0 is the unknown category.

    Shuffles of lines carry the number in place of two texts. Both tables are stored: the numbers are taken once, and
    joins are planned by the measured sizes.
    """
    listed = products.select("product_id", *[F.coalesce(name, F.lit(UNKNOWN)).alias(name) for name in CATEGORY])
    known = (F.col("department") != UNKNOWN) | (F.col("commodity_desc") != UNKNOWN)
    categories = stored(
        listed.select(*CATEGORY).filter(known).distinct().withColumn(NUMBER, F.monotonically_increasing_id() + 1)
    )
    numbered = listed.join(categories, CATEGORY, "left").select("product_id", F.coalesce(NUMBER, F.lit(0)).alias(NUMBER))
    unknown = products.sparkSession.range(1).select(*[F.lit(UNKNOWN).alias(name) for name in CATEGORY], F.col("id").alias(NUMBER))
    return stored(numbered), categories.unionByName(unknown)


def _category_measures(
    lines: DataFrame, products: DataFrame, sums: dict[str, Column], period: list[str] | None = None
) -> DataFrame:
    """Sums, distinct households and distinct baskets per category (and period).

    Lines get the number of their category, and only it and the counted key are shuffled, once per key; sums are added up
    before the shuffle. No task ever holds a whole category, since pairs are spread by household or basket. All parts meet
    in one aggregation, the text keys enter after it.
    """
    group = [NUMBER, *(period or [])]
    numbered, categories = numbered_categories(products)
    labelled = lines.join(numbered, "product_id", "left").withColumn(NUMBER, F.coalesce(NUMBER, F.lit(0)))

    def distinct_part(key: str, name: str) -> DataFrame:
        pairs = labelled.select(*group, key).distinct()
        return pairs.select(*group, F.col(key).isNotNull().cast("long").alias(name))

    summed = labelled.select(*group, *[column.alias(name) for name, column in sums.items()])
    parts = [summed, distinct_part("household_key", "households"), distinct_part("basket_id", "baskets")]
    stacked = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    # a category may take a third of all sales, more than a bigint of units holds
    wide = [wide_sum(name).alias(name) if name.endswith("_u") else F.sum(name).alias(name) for name in sums]
    measures = stacked.groupBy(*group).agg(
        *wide, F.sum("households").alias("households"), F.sum("baskets").alias("baskets")
    )
    return measures.join(categories, NUMBER).drop(NUMBER)


def mart_categories(tx: DataFrame, products: DataFrame, legacy: bool = False) -> DataFrame:
    """One row per category; ``legacy`` leaves coupons out of the discount denominator and has no growth rate."""
    sales, discount = units("sales_value"), discount_units()
    zero = F.lit(0).cast("long")
    grouped = _category_measures(
        tx,
        products,
        {
            "sales_u": sales,
            "units": F.col("quantity"),
            "discount_u": discount,
            "base_u": sales + (units("retail_discount_amt") if legacy else discount),
            "first_u": F.when(F.col("week_no") <= WEEKS_PER_YEAR, sales).otherwise(zero),
            "second_u": F.when(F.col("week_no") > WEEKS_PER_YEAR, sales).otherwise(zero),
        },
    )
    growth = F.col("second_u") - F.col("first_u")
    columns = [
        *CATEGORY,
        money("sales_u").alias("category_sales"),
        "units",
        F.col("households").alias("household_count"),
        positive_ratio(F.col("households"), distinct_total(tx, "household_key")).alias("household_penetration"),
        positive_ratio(F.col("baskets"), distinct_total(tx, "basket_id")).alias("basket_penetration"),
        positive_ratio(F.col("discount_u"), F.col("base_u")).alias("discount_rate"),
        money("first_u").alias("first_year_sales"),
        money("second_u").alias("second_year_sales"),
        money(growth).alias("sales_growth"),
    ]
    if not legacy:
        columns.append(positive_ratio(growth, F.col("first_u")).alias("sales_growth_rate"))
    return grouped.select(*columns)


def mart_category_period(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Category × thirteen-week period."""
    lines = tx.select(
        "product_id",
        "household_key",
        "basket_id",
        quarter_of_week("week_no").alias("quarter_like_period"),
        units("sales_value").alias("sales_u"),
    )
    grouped = _category_measures(lines, products, {"sales_u": F.col("sales_u")}, ["quarter_like_period"])
    return grouped.select(
        *CATEGORY, "quarter_like_period", money("sales_u").alias("sales"), "households", "baskets"
    )


def mart_category_diagnostics(categories: DataFrame, periods: DataFrame) -> DataFrame:
    """Category mart with stability, engagement and attention flags.

    Both inputs are read several times, so they are stored first; from there on the plan is category-sized.
    """
    categories, periods = stored(categories), stored(periods)
    last = periods.agg(F.max("quarter_like_period")).scalar()
    per_category = periods.groupBy(*CATEGORY).agg(
        (F.sum(wide_units("sales")) / (F.count(F.lit(1)) * 10000.0)).alias("mean_period_sales"),
        F.stddev_samp("sales").alias("sd_period_sales"),
        F.max(F.when(F.col("quarter_like_period") == 1, F.col("households"))).alias("_first_households"),
        F.max(F.when(F.col("quarter_like_period") == last, F.col("households"))).alias("_last_households"),
    )
    spend_per_household = nonzero_ratio(F.col("category_sales"), F.col("household_count"))
    thresholds = quantile_row(
        categories,
        {
            "sales_p75": (F.col("category_sales"), 0.75),
            "penetration_p75": (F.col("household_penetration"), 0.75),
            "spend_median": (spend_per_household, 0.5),
        },
    )

    def at_least(column: str, threshold: str):
        return F.col(column) >= thresholds.select(threshold).scalar()

    def flag(condition):
        return F.when(condition, 1).otherwise(0)

    big_and_declining = at_least("category_sales", "sales_p75") & (F.col("sales_growth") < 0)
    wide_and_light = at_least("household_penetration", "penetration_p75") & (
        spend_per_household <= thresholds.select("spend_median").scalar()
    )
    return categories.join(per_category, CATEGORY).select(
        *categories.columns,
        "mean_period_sales",
        "sd_period_sales",
        nonzero_ratio(F.col("sd_period_sales"), F.col("mean_period_sales")).alias("sales_coefficient_of_variation"),
        (F.col("_last_households") - F.col("_first_households")).alias("household_engagement_change"),
        flag(F.col("household_count") < SMALL_GROUP_HOUSEHOLDS).alias("small_group_flag"),
        flag(big_and_declining).alias("high_sales_declining_flag"),
        flag(wide_and_light).alias("high_penetration_low_spend_flag"),
    )


def min_support(frame: DataFrame, column: str, least: int) -> DataFrame:
    """Rows whose denominator reaches the minimum."""
    return frame.filter(F.col(column) >= least)


def top_categories(frame: DataFrame, measure: str, count: int, min_households: int) -> DataFrame:
    """The ``count`` leading categories by a measure among those with enough buying households."""
    supported = min_support(frame, "household_count", min_households)
    return supported.orderBy(F.col(measure).desc(), *CATEGORY).limit(count)
