"""Product grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import discount_units, money, positive_ratio, units
from basketmart.functions.timegrid import quarter_of_week
from basketmart.plans.baskets import distinct_total

ATTRIBUTES = ["manufacturer", "brand", "curr_size_of_product", "department", "commodity_desc", "sub_commodity_desc"]


def quarter_bounds(tx: DataFrame) -> DataFrame:
    """First and last quarter-like period of the fact, one row."""
    return tx.agg(
        quarter_of_week(F.min("week_no")).alias("first_quarter"), quarter_of_week(F.max("week_no")).alias("last_quarter")
    )


def product_attributes(products: DataFrame) -> DataFrame:
    """One row per product id with ``copies``, the number of metadata rows it has.

    An attribute that differs between copies resolves to its largest value, so the choice never depends on row order.
    """
    return products.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("copies"), *[F.max(name).alias(name) for name in ATTRIBUTES]
    )


def product_units_table(tx: DataFrame, first_quarter=None) -> DataFrame:
    """Per product: sums in units, distinct baskets and households, repeat households, first and last quarter sales.

    Grouping by product and household first keeps a product bought everywhere spread over its households, and a
    household repeats exactly if its smallest and largest basket differ. Distinct baskets come from product-basket
    pairs. Both parts meet in one aggregation instead of a join.
    """
    bounds = quarter_bounds(tx)
    first = first_quarter if first_quarter is not None else bounds.select("first_quarter").scalar()
    quarter = quarter_of_week("week_no")
    sales = units("sales_value")
    discount = discount_units()
    by_household = tx.groupBy("product_id", "household_key").agg(
        F.min("basket_id").alias("low_basket"),
        F.max("basket_id").alias("high_basket"),
        F.sum(sales).alias("sales_u"),
        F.sum("quantity").alias("units"),
        F.sum(discount).alias("discount_u"),
        F.sum(sales + discount).alias("gross_u"),
        F.sum(sales + units("retail_discount_amt")).alias("net_retail_u"),
        F.sum(F.when(quarter == first, sales)).alias("first_u"),
        F.sum(F.when(quarter == bounds.select("last_quarter").scalar(), sales)).alias("last_u"),
    )
    has_household = F.col("household_key").isNotNull()
    repeats = has_household & F.col("product_id").isNotNull() & (F.col("low_basket") != F.col("high_basket"))
    households = by_household.select(
        "product_id",
        "sales_u",
        "units",
        "discount_u",
        "gross_u",
        "net_retail_u",
        "first_u",
        "last_u",
        has_household.cast("long").alias("households"),
        F.coalesce(repeats, F.lit(False)).cast("long").alias("repeat_households"),
    )
    baskets = (
        tx.select("product_id", "basket_id")
        .distinct()
        .select("product_id", F.col("basket_id").isNotNull().cast("long").alias("baskets"))
    )
    parts = households.unionByName(baskets, allowMissingColumns=True)
    measures = [name for name in parts.columns if name != "product_id"]
    return parts.groupBy("product_id").agg(*[F.sum(name).alias(name) for name in measures])


def product_buyers(tx: DataFrame) -> DataFrame:
    """Households that bought each product: the denominator of repeat purchase."""
    pairs = tx.select("product_id", "household_key").distinct()
    return pairs.groupBy("product_id").agg(F.count("household_key").alias("households"))


def mart_products(tx: DataFrame, products: DataFrame, legacy: bool = False) -> DataFrame:
    """One row per product sold.

    ``legacy`` keeps the older convention: growth from quarter 1 whatever the first quarter is, coupons outside the
    discount denominator, and only the three category attributes.
    """
    known = F.col("product_id").isNotNull()
    first, last = F.when(known, F.col("first_u")), F.when(known, F.col("last_u"))
    growth = F.coalesce(last, F.lit(0)) - F.coalesce(first, F.lit(0))
    copies = F.coalesce("copies", F.lit(1))  # a product listed twice counts its lines twice
    base = F.col("net_retail_u") if legacy else F.col("gross_u")
    attributes = ATTRIBUTES[3:] if legacy else ATTRIBUTES
    joined = product_units_table(tx, F.lit(1) if legacy else None).join(
        product_attributes(products), "product_id", "left"
    )
    columns = [
        "product_id",
        *attributes,
        money(F.col("sales_u") * copies).alias("product_sales"),
        (F.col("units") * copies).alias("units"),
        positive_ratio(F.col("baskets"), distinct_total(tx, "basket_id")).alias("basket_penetration"),
        positive_ratio(F.col("households"), distinct_total(tx, "household_key")).alias("household_penetration"),
        positive_ratio(F.col("discount_u"), base).alias("discount_rate"),
        money(growth).alias("sales_growth"),
        F.col("repeat_households").alias("repeat_household_count"),
    ]
    if not legacy:
        rate = F.when(first > 0, (last - first) / first.cast("double")).alias("sales_growth_rate")
        columns.insert(-1, rate)
    return joined.select(*columns)
