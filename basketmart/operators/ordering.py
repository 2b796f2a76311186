"""Global order on a cluster: positions, ntiles, running totals, tied ranks and exact quantiles.

A window without a partition sends every row to one task. Here rows are range-partitioned by the order columns, so each
slice holds a contiguous piece of the order; a row's place is its place inside the slice plus the number of rows in
earlier slices. A group of any size is spread over as many slices as it needs.

``repartitionByRange`` samples its input, so evaluating it twice may cut the slices differently. The sliced rows are
therefore written to the shared checkpoint folder once, with the slice and the place inside it stored as data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.session import stored

SLICE, PLACE = "_slice", "_place"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition number above 33 bits of row number


def sliced(frame: DataFrame, order_by: list[Column | str]) -> DataFrame:
    """Stored rows with the number of their slice and their place in it, both starting at 0."""
    ids = (
        frame.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return stored(ids.withColumns({SLICE: F.shiftright("_id", _PLACE_BITS), PLACE: place}).drop("_id"))


def _slice_offsets(rows: DataFrame, groups: list[str], amount: Column) -> DataFrame:
    """Per slice and group: first place, sum of ``amount`` in earlier slices and over the whole group.

    Has at most (slices + groups) rows, whatever the number of input rows.
    """
    per_slice = rows.groupBy(SLICE, *groups).agg(F.min(PLACE).alias("_first"), F.sum(amount).alias("_amount"))
    whole = W.partitionBy(*groups)
    earlier = whole.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    return per_slice.select(
        F.col(SLICE).alias("_o_slice"),
        *[F.col(g).alias(f"_o_{g}") for g in groups],
        "_first",
        F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_amount").over(whole).alias("_total"),
    )


def _with_offsets(rows: DataFrame, groups: list[str], amount: Column) -> DataFrame:
    offsets = _slice_offsets(rows, groups, amount)
    same = F.col(SLICE) == F.col("_o_slice")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    # without groups there is one row per slice, i.e. at most spark.sql.shuffle.partitions of them
    joined = rows.join(offsets if groups else F.broadcast(offsets), same)
    return joined.drop("_o_slice", *[f"_o_{g}" for g in groups])


def row_numbers(
    frame: DataFrame, order_by: list[Column | str], groups: list[str] | None = None, name: str = "row_number"
) -> DataFrame:
    """``row_number() over (partition by groups order by order_by)`` plus ``<name>_of``, the group's row count.

    ``order_by`` must be a total order inside a group.
    """
    groups = groups or []
    rows = sliced(frame, [*groups, *order_by])
    placed = _with_offsets(rows, groups, F.lit(1).cast("long"))
    number = F.col(PLACE) - F.col("_first") + F.col("_before") + 1
    return placed.withColumns({name: number, f"{name}_of": F.col("_total")}).drop(
        SLICE, PLACE, "_first", "_before", "_total"
    )


def ntile(
    frame: DataFrame, tiles: int, order_by: list[Column | str], groups: list[str] | None = None, name: str = "tile"
) -> DataFrame:
    """``ntile(tiles)`` of a total order; the first ``n % tiles`` tiles hold one row more than the rest."""
    numbered = row_numbers(frame, order_by, groups, "_rn")
    place = F.col("_rn") - 1
    # tiles are filled one after the other, so a row's tile follows from its number and the two tile sizes
    large = F.expr(f"_rn_of div {tiles} + 1")
    large_rows = F.expr(f"_rn_of % {tiles}") * large
    in_large = F.floor(place / large) + 1
    in_small = F.expr(f"_rn_of % {tiles}") + F.floor((place - large_rows) / F.greatest(large - 1, F.lit(1))) + 1
    return numbered.withColumn(name, F.when(place < large_rows, in_large).otherwise(in_small).cast("int")).drop(
        "_rn", "_rn_of"
    )


def running_total(
    frame: DataFrame,
    amount: str,
    order_by: list[Column | str],
    groups: list[str] | None = None,
    name: str = "running_total",
) -> DataFrame:
    """Inclusive running sum of a bigint column in a total order, plus ``<name>_of``, the group's sum; both decimal(30, 0),
    as a sum of bigints may exceed one."""
    groups = groups or []
    rows = sliced(frame, [*groups, *order_by])
    inside = W.partitionBy(SLICE, *groups).orderBy(PLACE).rowsBetween(W.unboundedPreceding, W.currentRow)
    wide = F.col(amount).cast("decimal(20,0)")
    local = rows.withColumn("_local", F.sum(wide).over(inside))
    placed = _with_offsets(local, groups, wide)
    total = F.col("_before") + F.col("_local")
    return placed.withColumns({name: total, f"{name}_of": F.col("_total")}).drop(
        SLICE, PLACE, "_local", "_first", "_before", "_total"
    )


def value_ranks(frame: DataFrame, series: dict[str, Column]) -> DataFrame:
    """Histogram of several numeric series with tied ranks: ``series, value, rows, below, rank, series_rows``.

    ``rank`` is the average rank of the rows holding the value, ``below`` the number of rows with a smaller value.
    NULL values do not take part. Equal values collapse map-side, so a value held by most rows costs one row per task.
    """
    pairs = ", ".join(f"'{name}', _v{i}" for i, name in enumerate(series))
    melted = frame.select(*[column.cast("double").alias(f"_v{i}") for i, column in enumerate(series.values())]).select(
        F.expr(f"stack({len(series)}, {pairs}) as (series, value)")
    )
    histogram = melted.filter(F.col("value").isNotNull()).groupBy("series", "value").agg(F.count("*").alias("rows"))
    ranked = running_total(histogram, "rows", ["value"], ["series"], "_upto")
    return ranked.select(
        "series",
        "value",
        "rows",
        (F.col("_upto") - F.col("rows")).alias("below"),
        (F.col("_upto") - (F.col("rows") - 1) / 2).alias("rank"),
        F.col("_upto_of").alias("series_rows"),
    )


def quantiles_of(ranked: DataFrame, probabilities: list[float]) -> DataFrame:
    """Interpolated quantiles ``series, probability, quantile`` of a histogram from :func:`value_ranks`."""
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    target = F.col("probability") * (F.col("series_rows") - 1)

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("below") <= position) & (position < F.col("below") + F.col("rows")), F.col("value")))

    touched = (F.col("below") <= F.ceil(target)) & (F.floor(target) < F.col("below") + F.col("rows"))
    picked = (
        ranked.withColumn("probability", wanted)
        .filter(touched)
        .groupBy("series", "probability", "series_rows")
        .agg(at(F.floor(target)).alias("low"), at(F.ceil(target)).alias("high"))
    )
    share = target - F.floor(target)
    return picked.select(
        "series", "probability", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("quantile")
    )


def exact_quantiles(frame: DataFrame, series: dict[str, Column], probabilities: list[float]) -> DataFrame:
    """Interpolated quantiles ``series, probability, quantile``; equal to ``percentile`` but never in one task."""
    return quantiles_of(value_ranks(frame, series), probabilities)


def rows_above_quantile(frame: DataFrame, series: dict[str, Column], probability: float) -> DataFrame:
    """``series, quantile, rows``: how many rows exceed a series' own quantile, counted on the histogram."""
    ranked = value_ranks(frame, series)
    cuts = quantiles_of(ranked, [probability])
    above = F.when(F.col("value") > F.col("quantile"), F.col("rows")).otherwise(F.lit(0).cast("long"))
    # one row per series
    return ranked.join(F.broadcast(cuts), "series").groupBy("series", "quantile").agg(F.sum(above).alias("rows"))


def quantile_row(frame: DataFrame, wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """One row with one exact quantile per entry ``name -> (column, probability)``."""
    series = {name: column for name, (column, _) in wanted.items()}
    levels = sorted({p for _, p in wanted.values()})
    found = exact_quantiles(frame, series, levels)
    return found.agg(
        *[
            F.max(F.when((F.col("series") == name) & (F.col("probability") == p), F.col("quantile"))).alias(name)
            for name, (_, p) in wanted.items()
        ]
    )


def tied_ranks(frame: DataFrame, column: str, series: dict[str, Column]) -> DataFrame:
    """Add the average rank of ``column`` among the rows of each series (new column -> condition on the rows).

    Rows are cut into slices by value and row number, so rows that are equal in every column are spread like any others.
    A row's rank follows from the rows before its value and those that hold it, counted within its slice; only a slice's
    first and last value may go on in another one, and the table of these has two rows a slice. Rows outside a series, or
    with a NULL in ``column``, have no rank in it. ``frame`` should be stored, as its row numbers are taken once.
    """
    taken = {f"_in{k}": condition for k, condition in enumerate(series.values())}
    held = F.col(column).isNotNull()
    rows = frame.withColumns(
        {
            "_value": F.col(column).cast("double"),
            "_spread": F.monotonically_increasing_id(),
            **{name: F.when(held & condition, 1).otherwise(0).cast("long") for name, condition in taken.items()},
        }
    )
    rows = sliced(rows, ["_value", "_spread"])
    peers, upto = W.partitionBy(SLICE, "_value"), W.partitionBy(SLICE).orderBy("_value")
    upto = upto.rangeBetween(W.unboundedPreceding, W.currentRow)
    numbers = range(len(series))
    local = rows.withColumns(
        {f"_same{k}": F.sum(f"_in{k}").over(peers) for k in numbers} | {f"_upto{k}": F.sum(f"_in{k}").over(upto) for k in numbers}
    )
    # counted before they are gathered, so a slice sends one row for each of its values at most
    counted = rows.filter(held).groupBy(SLICE, "_value").agg(*[F.sum(f"_in{k}").alias(f"_same{k}") for k in numbers])
    edges = counted.groupBy(SLICE).agg(
        F.min("_value").alias("_first"),
        F.max("_value").alias("_last"),
        *[F.sum(f"_same{k}").alias(f"_n{k}") for k in numbers],
        *[F.min_by(f"_same{k}", "_value").alias(f"_first{k}") for k in numbers],
        *[F.max_by(f"_same{k}", "_value").alias(f"_last{k}") for k in numbers],
    )
    earlier = W.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)  # one row a slice
    edges = stored(
        edges.withColumns({f"_before{k}": F.coalesce(F.sum(f"_n{k}").over(earlier), F.lit(0)) for k in numbers})
    )
    first = F.struct(
        F.col("_first").alias("_edge"),
        *[F.col(f"_before{k}").alias(f"_below{k}") for k in numbers],
        *[F.col(f"_first{k}").alias(f"_all{k}") for k in numbers],
    )
    last = F.struct(
        F.col("_last").alias("_edge"),
        *[(F.col(f"_before{k}") + F.col(f"_n{k}") - F.col(f"_last{k}")).alias(f"_below{k}") for k in numbers],
        *[F.col(f"_last{k}").alias(f"_all{k}") for k in numbers],
    )
    both = F.when(F.col("_first") == F.col("_last"), F.array(first)).otherwise(F.array(first, last))
    spans = edges.select(F.explode(both).alias("e")).select("e.*").groupBy("_edge").agg(
        *[F.min(f"_below{k}").alias(f"_below{k}") for k in numbers], *[F.sum(f"_all{k}").alias(f"_all{k}") for k in numbers]
    )
    # at most one and two rows a slice, that is a shuffle partition
    offsets = F.broadcast(edges.select(F.col(SLICE).alias("_o_slice"), *[f"_before{k}" for k in numbers]))
    placed = local.join(offsets, F.col(SLICE) == F.col("_o_slice"), "left")
    placed = placed.join(F.broadcast(spans), F.col("_value") == F.col("_edge"), "left")
    ranks = []
    for k, name in enumerate(series):
        below = F.coalesce(f"_below{k}", F.col(f"_before{k}") + F.col(f"_upto{k}") - F.col(f"_same{k}"))
        rank = below + (F.coalesce(f"_all{k}", f"_same{k}") + 1) / 2
        ranks.append(F.when(F.col(f"_in{k}") == 1, rank).alias(name))
    return placed.select(*frame.columns, *ranks)
