"""Statistical evidence: descriptives, tests, effect sizes, bootstrap intervals and experiment sizing."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, nonzero_ratio, positive_ratio, units, wide_sum
from basketmart.operators.ordering import quantile_row, tied_ranks, value_ranks
from basketmart.session import stored

BASKET_MEASURES = ["basket_spend", "basket_units", "discount_rate"]
Z_ALPHA, Z_POWER = 1.96, 0.84  # two-sided 5 % test at 80 % power
ARM_SIZES = [250, 500, 1000, 1500]
LIFTS = [0.03, 0.04, 0.05, 0.075, 0.10]
REPLICATES = 500
PRIME = 2**31 - 1


def basket_descriptives(baskets: DataFrame) -> DataFrame:
    """Mean, median and spread of basket spend, units and discount rate, one row."""
    medians = quantile_row(baskets, {name: (F.col(name), 0.5) for name in BASKET_MEASURES})
    rows = F.count(F.lit(1))
    means = baskets.agg(
        mean_money(wide_sum(units("basket_spend")), rows).alias("mean_basket_spend"),
        F.stddev_samp("basket_spend").alias("sd_basket_spend"),
        F.avg("basket_units").alias("mean_basket_units"),
        F.avg("discount_rate").alias("mean_discount_rate"),
    )
    return means.select(
        "mean_basket_spend",
        medians.select("basket_spend").scalar().alias("median_basket_spend"),
        "sd_basket_spend",
        "mean_basket_units",
        medians.select("basket_units").scalar().alias("median_basket_units"),
        "mean_discount_rate",
        medians.select("discount_rate").scalar().alias("median_discount_rate"),
    )


def event_probabilities(baskets: DataFrame, period_summary: DataFrame) -> DataFrame:
    """Share of coupon baskets, of baskets above 50, and adjacent retention over prior-active households."""
    rows = F.count(F.lit(1))
    retained = period_summary.agg(
        nonzero_ratio(F.sum("retained_households"), F.sum("prior_active_households")).alias("retention")
    )
    shares = baskets.agg(
        positive_ratio(F.sum("coupon_used_flag"), rows).alias("coupon_basket_probability"),
        positive_ratio(F.count_if(F.col("basket_spend") > 50), rows).alias("basket_over_50_probability"),
    )
    return shares.select("*", retained.scalar().alias("adjacent_retention_probability"))


# --- bootstrap -------------------------------------------------------------------------------------------------------


def _hash32(text: Column) -> Column:
    """First 32 bits of md5 as bigint; the same number in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _poisson_weight(uniform: Column) -> Column:
    """Poisson(1) draw by inverse distribution function; mass beyond 12 is below the hash's resolution."""
    reached = 0.0
    steps = []
    for k in range(13):
        reached += exp(-1.0) / factorial(k)
        steps.append((uniform >= F.lit(reached)).cast("long"))
    return reduce(Column.__add__, steps)


def bootstrap_interval(frame: DataFrame, key: str, amount_units: str, measure: str) -> DataFrame:
    """95 % bootstrap interval of a mean, one row.

    Every row is resampled in every replicate with a Poisson(1) weight. Two numbers below a prime, from the md5 of the
    row's key, give its draw for replicate r as ``(first * (r + 1) + second) mod prime``: uniform, independent between rows
    and pairwise independent between replicates. Replicates are summed where the rows are, so a task sends on at most
    five hundred of them.
    """
    text = F.col(key).cast("string")
    seeded = frame.select(
        F.col(amount_units).alias("u"),
        (_hash32(text) % PRIME).alias("first"),
        (_hash32(F.concat(text, F.lit("-"))) % PRIME).alias("second"),
    ).filter(F.col("u").isNotNull())
    drawn = seeded.select("u", "first", "second", F.explode(F.sequence(F.lit(1), F.lit(REPLICATES))).alias("replicate"))
    draw = (F.col("first") * F.col("replicate").cast("long") + F.col("second")) % PRIME
    weighted = drawn.select("replicate", "u", _poisson_weight(draw / F.lit(float(PRIME))).alias("w")).filter("w > 0")
    means = weighted.groupBy("replicate").agg(
        mean_money(wide_sum(F.col("w") * F.col("u")), F.sum("w")).alias("mean")
    )
    # always 500 rows
    return means.agg(
        F.percentile("mean", F.lit(0.025)).alias("lower"), F.percentile("mean", F.lit(0.975)).alias("upper")
    ).select(F.lit(measure).alias("measure"), "lower", "upper")


def bootstrap_ci(baskets: DataFrame) -> DataFrame:
    """Bootstrap intervals of mean basket spend and mean household spend."""
    per_basket = baskets.select("basket_id", units("basket_spend").alias("u"))
    per_household = baskets.groupBy("household_key").agg(F.sum(units("basket_spend")).alias("u"))
    return bootstrap_interval(per_basket, "basket_id", "u", "basket_spend").unionByName(
        bootstrap_interval(per_household, "household_key", "u", "household_spend")
    )


# --- early against late spend ----------------------------------------------------------------------------------------


def early_late_spend(periods: DataFrame) -> DataFrame:
    """Size, mean and variance of household-period spend up to and after the median period, one row."""
    by_period = periods.groupBy("period_id").agg(F.count(F.lit(1)).alias("n"))
    middle = by_period.agg(F.percentile("period_id", F.lit(0.5), F.col("n"))).scalar()
    early = F.col("period_id") <= middle
    spend = F.col("total_spend")

    def side(condition: Column, name: str) -> list[Column]:
        rows = F.count(F.when(condition, spend))
        total = wide_sum(F.when(condition, units("total_spend")))
        return [
            rows.alias(f"{name}_rows"),
            mean_money(total, rows).alias(f"{name}_mean"),
            F.var_samp(F.when(condition, spend)).alias(f"{name}_variance"),
        ]

    return periods.agg(*side(early, "early"), *side(~early, "late"))


def welch_spend(periods: DataFrame) -> DataFrame:
    """Welch's t (early minus late) with its degrees of freedom."""
    early = F.col("early_variance") / F.col("early_rows")
    late = F.col("late_variance") / F.col("late_rows")
    degrees = (early + late) ** 2 / (early**2 / (F.col("early_rows") - 1) + late**2 / (F.col("late_rows") - 1))
    return early_late_spend(periods).select(
        "early_rows",
        "late_rows",
        "early_mean",
        "late_mean",
        ((F.col("early_mean") - F.col("late_mean")) / F.sqrt(early + late)).alias("t_statistic"),
        degrees.alias("degrees_of_freedom"),
    )


def cohens_d(periods: DataFrame) -> DataFrame:
    """Standardised difference, late minus early."""
    pooled = F.sqrt((F.col("early_variance") + F.col("late_variance")) / 2)
    return early_late_spend(periods).select(
        ((F.col("late_mean") - F.col("early_mean")) / pooled).alias("late_minus_early_d")
    )


# --- discount groups -------------------------------------------------------------------------------------------------


def two_sample_ranks(frame: DataFrame, value: Column, first_group: Column) -> DataFrame:
    """Mann–Whitney summary of a value split in two groups, one row; rows with NULL value or group are left out."""
    usable = frame.select(value.cast("double").alias("value"), first_group.alias("first")).filter(
        F.col("value").isNotNull() & F.col("first").isNotNull()
    )
    ranked = value_ranks(usable, {"value": F.col("value")})
    members = usable.groupBy("value").agg(F.count_if("first").alias("first_rows"))
    joined = ranked.join(members, "value")
    summary = joined.agg(
        F.sum("first_rows").alias("first_rows"),
        (F.sum("rows") - F.sum("first_rows")).alias("second_rows"),
        F.sum(F.col("rank") * F.col("first_rows")).alias("first_rank_sum"),
        F.sum(F.col("rows").cast("double") ** 3 - F.col("rows")).alias("tie_term"),
    )
    first = F.col("first_rows").cast("double")
    return summary.withColumn("u_statistic", F.col("first_rank_sum") - first * (first + 1) / 2)


def discount_groups(categories: DataFrame, min_households: int = 0) -> DataFrame:
    """Sales of categories at or above the median discount rate against the rest."""
    population = stored(
        categories.filter(F.col("household_count") >= min_households).select("category_sales", "discount_rate")
    )
    middle = quantile_row(population, {"middle": (F.col("discount_rate"), 0.5)}).scalar()
    return two_sample_ranks(population, F.col("category_sales"), F.col("discount_rate") >= middle)


def mann_whitney_discount(categories: DataFrame, min_households: int = 0) -> DataFrame:
    """U of high-discount categories, with the normal score (ties and continuity corrected)."""
    n1, n2 = F.col("first_rows").cast("double"), F.col("second_rows").cast("double")
    n = n1 + n2
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("tie_term") / (n * (n - 1))))
    larger = F.greatest(F.col("u_statistic"), n1 * n2 - F.col("u_statistic"))
    return discount_groups(categories, min_households).select(
        F.col("first_rows").alias("high_discount_categories"),
        F.col("second_rows").alias("low_discount_categories"),
        "u_statistic",
        nonzero_ratio(larger - n1 * n2 / 2 - 0.5, spread).alias("z_score"),
    )


def rank_biserial(categories: DataFrame, min_households: int = 50) -> DataFrame:
    """Rank-biserial effect of the same comparison, by default among categories with enough households."""
    pairs = F.col("first_rows") * F.col("second_rows")
    return discount_groups(categories, min_households).select(
        F.col("first_rows").alias("high_discount_categories"),
        F.col("second_rows").alias("low_discount_categories"),
        "u_statistic",
        (2 * nonzero_ratio(F.col("u_statistic"), pairs) - 1).alias("rank_biserial"),
    )


# --- basket correlations ---------------------------------------------------------------------------------------------


def _matrix(frame: DataFrame, cells: dict[tuple[str, str], Column], name: str) -> DataFrame:
    """Aggregate every cell in one pass and return the symmetric matrix in long form."""
    pairs = list(cells)
    row = frame.agg(*[cells[pair].alias(f"_{i}") for i, pair in enumerate(pairs)])
    entries = []
    for i, (left, right) in enumerate(pairs):
        entries.append(f"'{left}', '{right}', _{i}")
        if left != right:
            entries.append(f"'{right}', '{left}', _{i}")
    return row.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) as (measure, other_measure, {name})")


def basket_covariance(baskets: DataFrame) -> DataFrame:
    """Sample covariance of the basket measures, each pair over its complete rows."""

    def cell(left: str, right: str) -> Column:
        both = F.col(left).isNotNull() & F.col(right).isNotNull()
        return F.covar_samp(F.when(both, F.col(left)), F.when(both, F.col(right)))

    pairs = combinations_with_replacement(BASKET_MEASURES, 2)
    return _matrix(baskets, {pair: cell(*pair) for pair in pairs}, "covariance")


def basket_spearman(baskets: DataFrame) -> DataFrame:
    """Spearman correlation of the basket measures, each pair ranked over its complete rows.

    Only the discount rate can be NULL, so two rankings suffice: over all baskets and over those with a rate.
    """
    measures = stored(baskets.select(*BASKET_MEASURES))
    rated = F.col("discount_rate").isNotNull()
    everyone = F.lit(True)
    ranked = tied_ranks(measures, "basket_spend", {"spend_all": everyone, "spend_rated": rated})
    ranked = tied_ranks(ranked, "basket_units", {"units_all": everyone, "units_rated": rated})
    ranked = tied_ranks(ranked, "discount_rate", {"rate_rated": rated})
    series = ["spend_rated", "units_rated", "rate_rated"]
    in_rated = {name: F.when(rated, F.col(name)) for name in series}
    cells = {
        ("basket_spend", "basket_spend"): F.lit(1.0),
        ("basket_spend", "basket_units"): F.corr("spend_all", "units_all"),
        ("basket_spend", "discount_rate"): F.corr(in_rated["spend_rated"], in_rated["rate_rated"]),
        ("basket_units", "basket_units"): F.lit(1.0),
        ("basket_units", "discount_rate"): F.corr(in_rated["units_rated"], in_rated["rate_rated"]),
        ("discount_rate", "discount_rate"): F.lit(1.0),
    }
    return _matrix(ranked, {pair: F.max(c) if i in (0, 3, 5) else c for i, (pair, c) in enumerate(cells.items())}, "rho")


# --- experiment sizing -----------------------------------------------------------------------------------------------


def experiment_mde(periods: DataFrame) -> DataFrame:
    """Smallest detectable change in four-week spend by arm size; the last, possibly cut, period is left out."""
    last = periods.agg(F.max("period_id")).scalar()
    rows = F.count("total_spend")
    base = periods.filter(F.col("period_id") < last).agg(
        mean_money(wide_sum(units("total_spend")), rows).alias("mean"), F.stddev_samp("total_spend").alias("sd")
    )
    arm = F.explode(F.array(*[F.lit(n) for n in ARM_SIZES]))
    detectable = (Z_ALPHA + Z_POWER) * 2**0.5 * F.col("sd") / F.sqrt("households_per_arm")
    return base.withColumn("households_per_arm", arm).select(
        "households_per_arm",
        detectable.alias("mde_spend"),
        (detectable * 100 / F.col("mean")).alias("mde_percent"),
    )


def sample_size_by_lift(baskets: DataFrame) -> DataFrame:
    """Households per group needed to detect a relative lift in household spend."""
    households = baskets.groupBy("household_key").agg(F.sum(units("basket_spend")).alias("u"))
    base = households.agg(
        mean_money(wide_sum("u"), F.count(F.lit(1))).alias("mean"), F.stddev_samp(F.col("u") / 10000.0).alias("sd")
    )
    lift = F.explode(F.array(*[F.lit(x) for x in LIFTS]))
    needed = 2 * ((Z_ALPHA + Z_POWER) * F.col("sd") / (F.col("mean") * F.col("lift"))) ** 2
    return base.withColumn("lift", lift).select(
        F.round(F.col("lift") * 100, 1).alias("lift_percent"),
        F.ceil(needed).cast("long").alias("households_per_group"),
    )
