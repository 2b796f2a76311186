"""Principal components of the scaled spend matrix by a block Krylov method, without a wide row and without a covariance.

The matrix stays in long form. The covariance is only ever applied to a thin block of columns, as two grouped sums over the
cells: once by household, once by commodity; centring is a correction by column means. Blocks are orthonormalised against
all earlier ones, and the covariance is projected on the space they span. The driver holds matrices as wide as that space
(``BLOCK`` columns a step), never one as wide as the matrix; blocks are tables with one row for each commodity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmart.plans.matrix import scaled_cells
from basketmart.session import stored

EXTRA = 7  # columns of a block beyond the wanted components
MOST_STEPS = 40
ENOUGH = 1e-9  # change of the wanted shares between two steps that ends the iteration


def _gram(frame: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """Sums of the products of every left with every right column; partial matrices are added by Spark."""
    names = [*left, *[r for r in right if r not in left]]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(left), len(right)))
        for batch in batches:
            columns = {n: batch.column(n).to_numpy() for n in names}
            total += np.stack([columns[n] for n in left]) @ np.stack([columns[n] for n in right]).T
        at = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "value"])

    sums = frame.select(*names).mapInArrow(partial, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(len(left) * len(right))
    for row in sums.collect():  # as many entries as the matrix has
        out[row.at] = row.value
    return out.reshape(len(left), len(right))


def _combined(names: list[str], weights: np.ndarray) -> Column:
    return sum((F.col(n) * float(w) for n, w in zip(names, weights) if w), F.lit(0.0))


def _start(name: str, number: int) -> Column:
    """A reproducible number between -1 and 1 for a commodity."""
    return (F.pmod(F.xxhash64(name, F.lit(number)), F.lit(2_000_001)) / 1_000_000.0) - 1.0


def _applied(cells: DataFrame, basis: DataFrame, names: list[str], shift: np.ndarray, households: int) -> DataFrame:
    """The covariance times columns of the basis: ``commodity_desc`` and ``z_0``, ``z_1``... Centring takes the score of the
    column means, ``shift``, from the score of each household; it then cancels out in the sum over households."""
    block = basis.select("commodity_desc", *names)
    scores = (
        cells.join(block, "commodity_desc")
        .groupBy("household_key")
        .agg(*[(F.sum(F.col("x") * F.col(n)) - float(s)).alias(n) for n, s in zip(names, shift)])
    )
    products = [(F.sum(F.col("x") * F.col(n)) / (households - 1)).alias(f"z_{k}") for k, n in enumerate(names)]
    return cells.join(scores, "household_key").groupBy("commodity_desc").agg(*products)


def _turned(square: np.ndarray, least: float) -> np.ndarray:
    """Weights that make columns with these products orthonormal; directions shorter than ``least`` are dropped."""
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    good = values > least
    return vectors[:, good] / np.sqrt(values[good])


def pca_variance(cells: DataFrame, components: int = 5) -> DataFrame:
    """Share of variance of the leading components of the scaled, centred matrix: ``component, variance_share,
    cumulative_share``. At most as many components as there are commodities; none without variance.

    The shares are the largest eigenvalues of the covariance on the Krylov space of a random block, divided by its trace. A
    space as large as the matrix is wide gives them exactly; otherwise steps end when they stop changing. A column is
    taken out of the earlier ones twice, against rounding.
    """
    spark = cells.sparkSession
    schema = "component int, variance_share double, cumulative_share double"
    households, columns = cells.agg(F.count_distinct("household_key"), F.count_distinct("commodity_desc")).first()
    cells = stored(scaled_cells(cells).filter("x <> 0"))
    means = cells.groupBy("commodity_desc").agg(
        (F.sum("x") / households).alias("mean"), (F.sum(F.col("x") * F.col("x")) / households).alias("square")
    )
    width = min(columns, components + EXTRA)
    starts = [_start("commodity_desc", k).alias(f"w_{k}") for k in range(width)]
    block = stored(means.select("*", *starts))
    spread = F.col("square") - F.col("mean") * F.col("mean")
    trace = block.agg(F.sum(F.when(spread > 1e-12 * F.col("square"), spread).otherwise(0.0))).first()[0] or 0.0
    if trace <= 0.0:
        return spark.createDataFrame([], schema)
    trace *= households / (households - 1)
    held: list[str] = []
    names = [f"w_{k}" for k in range(width)]
    least = 0.0
    shift, projected, shares = np.zeros(0), np.zeros((0, 0)), np.zeros(components)
    for step in range(MOST_STEPS):
        # the rest of the new columns outside the space, made orthonormal
        products = _gram(block, [*held, *names, "mean"], names)
        inside, square, mean = products[: len(held)], products[len(held) : -1], products[-1]
        turn = _turned(square - inside.T @ inside, max(least, 1e-18 * np.trace(square)))
        if not turn.shape[1]:
            break
        weights = np.vstack([-inside @ turn, turn])
        new = [f"q{step}_{k}" for k in range(turn.shape[1])]
        made = [_combined([*held, *names], weights[:, k]).alias(n) for k, n in enumerate(new)]
        basis = stored(block.select("commodity_desc", "mean", *held, *made))
        newest = len(new)
        shift = np.concatenate([shift, (mean - shift @ inside) @ turn])
        held += new
        names = [f"z_{k}" for k in range(newest)]
        # the space's projection of the covariance grows by the new columns
        product = _applied(cells, basis, new, shift[-newest:], households)
        block = stored(basis.join(product, "commodity_desc"))
        side = _gram(block, held, names)
        grown = np.zeros((len(held), len(held)))
        grown[: len(projected), : len(projected)] = projected
        grown[:, -newest:] = side
        grown[-newest:, :] = side.T
        projected = grown
        values = np.linalg.eigvalsh((projected + projected.T) / 2)[::-1][:components]
        found = np.zeros(components)
        found[: len(values)] = np.maximum(values, 0.0) / trace
        done = np.abs(found - shares).max() < ENOUGH
        shares = found
        if done or len(held) >= columns:
            break
        # first time out of the space; what is left of rounding is seen to above
        block = block.select(
            "commodity_desc",
            "mean",
            *held,
            *[(F.col(n) - _combined(held, side[:, k])).alias(n) for k, n in enumerate(names)],
        )
        least = 1e-18 * float((side * side).sum())
    shares = [float(s) for s in shares[: min(components, columns)]]
    rows = [(i + 1, share, sum(shares[: i + 1])) for i, share in enumerate(shares)]
    return spark.createDataFrame(rows, schema)
