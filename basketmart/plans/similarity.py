"""The most similar pair among all households: an exact, bound-pruned similarity join of sparse unit vectors.

1. Households with the same vector (to ten digits) are one; the smallest two keys of each stand for all.
2. A lower bound for the best cosine comes from sign projections: households that fall on the same side of a set of random
   hyperplanes are measured against the smallest of them. The bound is a real pair's cosine.
3. Commodities are put in one order, the widespread first. A household's cells are indexed only from where the norm of the
   cells so far reaches the bound. What lies before adds up to less than the bound with any other vector, so a pair that
   reaches the bound shares a commodity that is indexed on both sides.
4. Vectors at most ``radius = sqrt(2 - 2 * bound)`` apart differ by no more than that in any coordinate and in any norm of a
   part of their cells. The join's key therefore is the commodity and a grid over the cell's value and two such norms,
   which cuts a commodity that every household buys, too; the better the bound, the finer the grid.
5. The norms of sixteen parts bound the cosine of what the join finds; pairs that pass are measured exactly.
"""

from __future__ import annotations

from math import ceil, log2, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.operators.ordering import row_numbers
from basketmart.plans.matrix import scaled_cells
from basketmart.session import stored

TABLES, MOST_SIGNS = 6, 20  # sets of hyperplanes, and hyperplanes of a set
PARTS = 16  # parts of a vector whose norms bound a cosine
SLACK = 1e-8  # for rounding errors of sums


def unit_vectors(cells: DataFrame) -> DataFrame:
    """``household_key, place, x``: scaled cells divided by the household's norm, ``place`` is the commodity's place in the
    order by households that hold it. Households whose cells are all zero have no direction and are left out."""
    cells = stored(scaled_cells(cells).filter("x <> 0"))
    held = cells.groupBy("commodity_desc").agg(F.count("*").alias("households"))
    order = row_numbers(held, [F.col("households").desc(), "commodity_desc"], name="place")
    norms = cells.groupBy("household_key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    placed = cells.join(order.select("commodity_desc", F.col("place").cast("int")), "commodity_desc")
    return placed.join(norms, "household_key").select("household_key", "place", (F.col("x") / F.col("norm")).alias("x"))


def _shapes(units: DataFrame) -> DataFrame:
    """``household_key`` and ``one``, the smallest household with the same vector."""
    # one entry for each commodity the household buys
    rows = units.groupBy("household_key").agg(
        F.sha2(F.array_sort(F.collect_list(F.struct("place", F.round("x", 10)))).cast("string"), 256).alias("shape")
    )
    ones = rows.groupBy("shape").agg(F.min("household_key").alias("one"))
    return rows.join(ones, "shape").select("household_key", "one")


def cosines(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Distinct pairs ``household_a, household_b`` with their exact ``cosine_similarity``; pairs that share nothing are dropped."""
    left = units.select(F.col("household_key").alias("household_a"), "place", F.col("x").alias("x_a"))
    right = units.select(F.col("household_key").alias("household_b"), "place", F.col("x").alias("x_b"))
    both = pairs.join(left, "household_a").join(right, ["household_b", "place"])
    return both.groupBy("household_a", "household_b").agg(F.sum(F.col("x_a") * F.col("x_b")).alias("cosine_similarity"))


def _lower_bound(units: DataFrame) -> float:
    """The best cosine among households that share the signs of a set of projections and the smallest of them."""
    households = units.agg(F.count_distinct("household_key")).first()[0]
    signs = min(MOST_SIGNS, max(1, ceil(log2(max(2, households)))))

    def sign(number: int) -> Column:
        # one bit of a hash of (place, word) decides on which side a commodity counts
        word = F.xxhash64("place", F.lit(number // 64))
        return 1.0 - 2.0 * F.shiftrightunsigned(word, number % 64).bitwiseAND(F.lit(1)).cast("double")

    sums = [F.sum(F.col("x") * sign(n)).alias(f"p{n}") for n in range(TABLES * signs)]
    projected = units.groupBy("household_key").agg(*sums)
    sets = [
        F.struct(
            F.lit(t).alias("set"),
            F.concat(*[F.when(F.col(f"p{t * signs + k}") > 0, "1").otherwise("0") for k in range(signs)]).alias("side"),
        )
        for t in range(TABLES)
    ]
    sides = stored(projected.select("household_key", F.explode(F.array(*sets)).alias("s")).select("household_key", "s.*"))
    first = sides.groupBy("set", "side").agg(F.min("household_key").alias("household_a"))
    pairs = sides.join(first, ["set", "side"]).filter("household_a <> household_key")
    pairs = pairs.select("household_a", F.col("household_key").alias("household_b")).distinct()
    return cosines(pairs, units).agg(F.max("cosine_similarity")).first()[0] or 0.0


def _index(units: DataFrame, bound: float) -> DataFrame:
    """The cells from where the norm so far reaches the bound, each with the norms of its vector's parts."""
    # a window holds one row for each commodity of a household
    upto = W.partitionBy("household_key").orderBy("place")
    squared = F.col("x") * F.col("x")
    kept = units.withColumn("reached", F.sqrt(F.sum(squared).over(upto))).filter(F.col("reached") >= bound - SLACK)
    norms = units.groupBy("household_key").agg(
        *[F.sqrt(F.sum(F.when(F.col("place") % PARTS == p, squared).otherwise(0.0))).alias(f"n{p}") for p in range(PARTS)]
    )
    return kept.select("household_key", "place", "x").join(norms, "household_key")


def candidates(units: DataFrame, bound: float) -> DataFrame:
    """Distinct pairs (smaller key first) that may reach the bound; all that do are among them."""
    rows = stored(_index(units, bound))
    radius = sqrt(max(0.0, 2.0 - 2.0 * (bound - SLACK)))
    width = 2 * radius
    axes = ["x", "n0", "n1"]  # the value and the norms of two parts

    def cell(value: Column) -> Column:
        return F.floor(value / width).cast("int")

    last = ceil(1 / width)
    left = rows.select("place", *[cell(F.col(axis)).alias(f"{axis}_cell") for axis in axes], *_side(rows, "a"))
    right = rows
    for axis in axes:
        # at most two cells reach within the radius; no value lies beyond one
        near = F.sequence(
            F.greatest(cell(F.col(axis) - radius), F.lit(-last)), F.least(cell(F.col(axis) + radius), F.lit(last))
        )
        right = right.withColumn(f"{axis}_cell", F.explode(near))
    right = right.select("place", *[f"{axis}_cell" for axis in axes], *_side(rows, "b"))
    reach = sum((F.col(f"n{p}_a") * F.col(f"n{p}_b") for p in range(1, PARTS)), F.col("n0_a") * F.col("n0_b"))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("place", *[f"{axis}_cell" for axis in axes])]
    found = left.alias("l").join(
        right.alias("r"), [*same, F.col("household_a") < F.col("household_b"), reach >= bound - SLACK]
    )
    return found.select("household_a", "household_b").distinct()


def _side(rows: DataFrame, side: str) -> list[Column]:
    return [F.col("household_key").alias(f"household_{side}"), *[F.col(f"n{p}").alias(f"n{p}_{side}") for p in range(PARTS)]]


def nearest_households_all(cells: DataFrame) -> DataFrame:
    """The pair of households with the highest cosine of scaled spend, one row; none with fewer than two households.

    Similarities that agree to nine digits are ties; they go to the smallest keys.
    """
    units = stored(unit_vectors(cells))
    shapes = stored(_shapes(units))
    twins = shapes.filter("household_key <> one").groupBy(F.col("one").alias("household_a")).agg(
        F.min("household_key").alias("household_b")
    )
    ones = shapes.filter("household_key = one").select("household_key")
    distinct = stored(units.join(ones, "household_key", "left_semi"))
    twins = stored(cosines(twins, units))
    bound = max(_lower_bound(distinct), twins.agg(F.max("cosine_similarity")).first()[0] or 0.0)
    found = cosines(candidates(distinct, bound), distinct).union(twins.select("household_a", "household_b", "cosine_similarity"))
    return found.orderBy(F.round("cosine_similarity", 9).desc(), "household_a", "household_b").limit(1)
