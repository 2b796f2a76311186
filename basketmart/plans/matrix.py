"""Household × commodity spend matrix: profile and similarity of a sample.

The matrix stays in long form (household, commodity, spend); absent cells are zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import units
from basketmart.plans.categories import UNKNOWN
from basketmart.session import stored


def spend_cells(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Spend in units per household and commodity; products are summed before their commodity is looked up."""
    bought = tx.groupBy("household_key", "product_id").agg(F.sum(units("sales_value")).alias("spend_u"))
    labels = products.select("product_id", "commodity_desc")
    return (
        bought.join(labels, "product_id", "left")
        .withColumn("commodity_desc", F.coalesce("commodity_desc", F.lit(UNKNOWN)))
        .groupBy("household_key", "commodity_desc")
        .agg(F.sum("spend_u").alias("spend_u"))
    )


def matrix_profile(cells: DataFrame) -> DataFrame:
    """Rows, columns and the share of zero cells, one row."""
    shape = cells.agg(
        F.count_distinct("household_key").alias("matrix_rows"),
        F.count_distinct("commodity_desc").alias("matrix_columns"),
        F.count_if(F.col("spend_u") != 0).alias("filled"),
    )
    size = F.col("matrix_rows") * F.col("matrix_columns")
    return shape.select("matrix_rows", "matrix_columns", (1 - F.col("filled") / size).alias("sparsity"))


def scaled_cells(cells: DataFrame) -> DataFrame:
    """Cells divided by their column's population deviation, zeros included; a constant column is left as it is.

    A household's cells, at most one for each commodity, lie together, so once stored, each sum by household is formed where
    the cells are read and shuffles one row a household.
    """
    households = cells.agg(F.count_distinct("household_key").cast("double")).scalar()
    spend = F.col("spend_u") / 10000.0
    columns = cells.groupBy("commodity_desc").agg(
        (F.sum(spend * spend) / households - (F.sum(spend) / households) ** 2).alias("variance")
    )
    deviation = F.when(F.col("variance") > 0, F.sqrt("variance")).otherwise(1.0)
    scaled = cells.join(columns, "commodity_desc").select(
        "household_key", "commodity_desc", (spend / deviation).alias("x")
    )
    return scaled.repartition("household_key")


def nearest_to_first_household(cells: DataFrame) -> DataFrame:
    """The household most similar (cosine of scaled spend) to the one with the smallest key, among all of them; one row.

    The first household's cells, one for each commodity, are looked up by the cells of every other household.
    """
    rows = stored(scaled_cells(cells))
    first = rows.agg(F.min("household_key")).scalar()
    anchor = rows.filter(F.col("household_key") == first).select("commodity_desc", F.col("x").alias("x_a"))
    length = F.sqrt(F.sum(F.col("x") * F.col("x")))
    own = rows.filter(F.col("household_key") == first).agg(length).scalar()
    near = (
        rows.join(anchor, "commodity_desc", "left")
        .groupBy("household_key")
        .agg(F.sum(F.col("x") * F.col("x_a")).alias("dot"), length.alias("norm"))
        .filter((F.col("household_key") != first) & F.col("dot").isNotNull())
    )
    return near.select(
        first.alias("household_a"),
        F.col("household_key").alias("household_b"),
        (F.col("dot") / (F.col("norm") * own)).alias("cosine_similarity"),
    ).orderBy(F.col("cosine_similarity").desc(), "household_b").limit(1)


def nearest_households(cells: DataFrame, sample: int = 250) -> DataFrame:
    """Most similar pair (cosine of scaled spend) among the first ``sample`` households, one row."""
    first = cells.select("household_key").distinct().orderBy("household_key").limit(sample)
    rows = stored(scaled_cells(cells).join(first, "household_key", "left_semi"))
    norms = rows.groupBy("household_key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))

    def side(suffix: str) -> DataFrame:
        return rows.join(norms, "household_key").select(
            F.col("household_key").alias(f"household_{suffix}"),
            "commodity_desc",
            (F.col("x") / F.col("norm")).alias(f"x_{suffix}"),
        )

    left = side("a")
    pairs = left.join(side("b"), "commodity_desc").filter(F.col("household_a") < F.col("household_b"))
    similarity = pairs.groupBy("household_a", "household_b").agg(
        F.sum(F.col("x_a") * F.col("x_b")).alias("cosine_similarity")
    )
    return similarity.orderBy(F.col("cosine_similarity").desc(), "household_a", "household_b").limit(1)

