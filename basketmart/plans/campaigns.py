"""Campaign, coupon and bias-aware evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketmart.functions.money import mean_money, positive_ratio, units, wide_sum
from basketmart.operators.ordering import ntile
from basketmart.session import stored

WINDOW_DAYS = 28


def redeemed_pairs(redemptions: DataFrame) -> DataFrame:
    """Household-campaign pairs with at least one redemption, and how many."""
    return redemptions.groupBy("household_key", "campaign").agg(F.count(F.lit(1)).alias("redemptions"))


def exposed_pairs(exposures: DataFrame) -> DataFrame:
    """Household-campaign pairs with ``copies``, the number of exposure rows they have (1 in clean data)."""
    return exposures.groupBy("household_key", "campaign").agg(F.count(F.lit(1)).alias("copies"))


def mart_campaigns(campaigns: DataFrame, exposures: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Exposure and redemption funnel of each campaign; only redemptions of exposed households count."""
    pairs = exposed_pairs(exposures).join(redeemed_pairs(redemptions), ["household_key", "campaign"], "left")
    per_campaign = pairs.groupBy("campaign").agg(
        F.count("household_key").alias("exposed_households"),
        F.count("redemptions").alias("redeeming_households"),
        F.sum(F.col("redemptions") * F.col("copies")).alias("redemption_count"),
    )
    joined = campaigns.join(per_campaign, "campaign", "left")
    counts = ["exposed_households", "redeeming_households", "redemption_count"]
    return joined.select(
        "campaign",
        "description",
        F.col("description").alias("campaign_type"),
        "start_day",
        "end_day",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in counts],
        positive_ratio(F.col("redeeming_households"), F.col("exposed_households")).alias("household_redemption_rate"),
    )


def campaign_funnel(mart: DataFrame, count: int = 10) -> DataFrame:
    """The campaigns with the widest reach."""
    return (
        mart.orderBy(F.col("exposed_households").desc(), "campaign")
        .limit(count)
        .select(
            "campaign",
            "campaign_type",
            "exposed_households",
            "redeeming_households",
            "redemption_count",
            "household_redemption_rate",
        )
    )


def mart_coupon_redemptions(redemptions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Redemption events with their campaign's type and dates."""
    described = campaigns.select("campaign", F.col("description").alias("campaign_type"), "start_day", "end_day")
    return redemptions.join(described, "campaign", "left").select(
        *redemptions.columns, "campaign_type", "start_day", "end_day"
    )


def household_day_ledger(tx: DataFrame, households: DataFrame | None = None) -> DataFrame:
    """Spend and baskets per household and day, small enough to answer any number of day windows.

    A basket seen on several days must count once per window. Each basket-day carries the basket's previous day, so a
    basket belongs to the window ``[a, b]`` exactly once: on its first day inside, where the previous day lies before
    ``a``. Counts by (day, previous day) can therefore be added up, and a household is left with about one row per
    active day however many lines it has. With ``households`` only theirs are kept, once lines are basket-days.
    """
    basket_days = tx.groupBy("household_key", "basket_id", "day").agg(F.sum(units("sales_value")).alias("sales_u"))
    if households is not None:
        basket_days = basket_days.join(households.select("household_key").distinct(), "household_key", "left_semi")
    basket = W.partitionBy("household_key", "basket_id").orderBy("day")
    return (
        basket_days.withColumn("previous_day", F.lag("day").over(basket))
        .groupBy("household_key", "day", "previous_day")
        .agg(F.sum("sales_u").alias("sales_u"), F.count("basket_id").alias("baskets"))
    )


def household_day_spend(tx: DataFrame, households: DataFrame) -> DataFrame:
    """The ledger without baskets: no window over baskets, one shuffle of what a task adds up for a household's day."""
    days = tx.groupBy("household_key", "day").agg(F.sum(units("sales_value")).alias("sales_u"))
    days = days.join(households.select("household_key").distinct(), "household_key", "left_semi")
    return days.withColumn("baskets", F.lit(0).cast("long"))


def totals_upto(ledger: DataFrame, probes: DataFrame) -> DataFrame:
    """The probes (``household_key, day`` and any other columns) with ``spend_upto`` and ``baskets_upto`` their day.

    Ledger and probes are merged in the order of days, and running totals are read where a probe stands. A household has
    one row for each day and probe, so what is shuffled does not depend on how long windows are or how many overlap.
    """
    entries = ledger.filter("day is not null").select("household_key", "day", "sales_u", "baskets", F.lit(0).alias("_probe"))
    both = entries.unionByName(probes.withColumn("_probe", F.lit(1)), allowMissingColumns=True)
    upto = W.partitionBy("household_key").orderBy("day", "_probe").rowsBetween(W.unboundedPreceding, W.currentRow)
    zero = F.lit(0).cast("long")
    running = both.withColumns(
        {
            "spend_upto": F.coalesce(F.sum("sales_u").over(upto), zero),
            "baskets_upto": F.coalesce(F.sum("baskets").over(upto), zero),
        }
    )
    return running.filter("_probe = 1").drop("sales_u", "baskets", "_probe")


def _window_probes(rows: DataFrame, windows: dict[str, tuple]) -> DataFrame:
    """Rows once for each end of their windows, as ``day`` and the sign with which each window (a name) counts it.

    A window's total is the total up to its last day less that up to the day before its first.
    """
    points = {}  # days that several windows share are one point
    for name, (first, last) in windows.items():
        points.setdefault(str(first - 1), (first - 1, {}))[1][name] = -1
        points.setdefault(str(last), (last, {}))[1][name] = 1
    structs = [
        F.struct(day.cast("int").alias("day"), *[F.lit(signs.get(name, 0)).alias(f"{name}_sign") for name in windows])
        for day, signs in points.values()
    ]
    return rows.withColumn("_point", F.explode(F.array(*structs))).select(*rows.columns, "_point.*")


def _signed(name: str, total: str):
    return F.sum(F.col(f"{name}_sign") * F.col(total))


def exposure_behaviour(tx: DataFrame, exposures: DataFrame, campaigns: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Each exposure with spend and baskets 28 days before and 28 days from the campaign start.

    An interval join (equal household, day inside the window) by running totals. Baskets seen on several days of a window,
    which are few, are counted off again by their ledger rows.
    """
    dated = exposed_pairs(exposures).join(
        campaigns.select("campaign", F.col("description").alias("campaign_type"), "start_day"), "campaign"
    )
    redeemed = redeemed_pairs(redemptions).select("household_key", "campaign", F.lit(1).alias("redeemed"))
    flagged = dated.join(redeemed, ["household_key", "campaign"], "left").withColumn(
        "redeemed_flag", F.coalesce("redeemed", F.lit(0))
    )
    flagged = flagged.drop("redeemed")
    start = F.col("start_day")
    first, last = start - WINDOW_DAYS, start + (WINDOW_DAYS - 1)
    ledger = stored(household_day_ledger(tx, exposures))
    key = ["household_key", "campaign", "campaign_type", "start_day", "redeemed_flag", "copies"]
    sums = (
        totals_upto(ledger, _window_probes(flagged, {"pre": (first, start - 1), "post": (start, last)}))
        .groupBy(*key)
        .agg(
            *[_signed(name, "spend_upto").alias(f"{name}_u") for name in ("pre", "post")],
            *[_signed(name, "baskets_upto").alias(f"{name}_baskets") for name in ("pre", "post")],
        )
    )
    again = ledger.filter("previous_day is not null").select("household_key", "day", "previous_day", "baskets")
    inside = (F.col("previous_day") >= first) & (F.col("day") <= last)
    zero = F.lit(0).cast("long")
    counted = flagged.join(again, "household_key").filter(inside)
    counted = counted.groupBy(*key).agg(
        F.sum(F.when(F.col("day") < start, F.col("baskets")).otherwise(zero)).alias("pre_again"),
        F.sum(F.when(F.col("previous_day") >= start, F.col("baskets")).otherwise(zero)).alias("post_again"),
    )
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in key]
    joined = sums.alias("s").join(counted.alias("c"), same, "left")
    return joined.select(
        *[F.col(f"s.{c}").alias(c) for c in key[:-1]],
        (F.col("pre_u") * F.col("s.copies")).alias("pre_u"),
        (F.col("post_u") * F.col("s.copies")).alias("post_u"),
        (F.col("pre_baskets") - F.coalesce("pre_again", zero)).alias("pre_baskets"),
        (F.col("post_baskets") - F.coalesce("post_again", zero)).alias("post_baskets"),
    )


def campaign_bias_comparison(
    tx: DataFrame, exposures: DataFrame, campaigns: DataFrame, redemptions: DataFrame
) -> DataFrame:
    """Equal-window comparison by campaign type, prior-spend quartile of the campaign and redemption."""
    behaviour = exposure_behaviour(tx, exposures, campaigns, redemptions)
    stratified = ntile(behaviour, 4, ["pre_u", "household_key"], ["campaign"], "prior_value_quartile")
    rows = F.count(F.lit(1))

    def mean(column):
        return mean_money(wide_sum(column), rows)

    return stratified.groupBy("campaign_type", "prior_value_quartile", "redeemed_flag").agg(
        rows.alias("household_campaign_exposures"),
        mean("pre_u").alias("avg_pre_spend"),
        mean("post_u").alias("avg_post_spend"),
        mean(F.col("post_u") - F.col("pre_u")).alias("avg_spend_change"),
        F.avg("pre_baskets").alias("avg_pre_baskets"),
        F.avg("post_baskets").alias("avg_post_baskets"),
        F.avg(F.col("post_baskets") - F.col("pre_baskets")).alias("avg_basket_change"),
    )


def campaign_segment_analysis(
    segments: DataFrame, exposures: DataFrame, campaigns: DataFrame, redemptions: DataFrame
) -> DataFrame:
    """Redemption by campaign type and household segment."""
    described = exposures.join(campaigns.select("campaign", F.col("description").alias("campaign_type")), "campaign")
    redeemed = redeemed_pairs(redemptions)
    joined = described.join(segments.select("household_key", "segment"), "household_key").join(
        redeemed, ["household_key", "campaign"], "left"
    )
    rows, hits = F.count(F.lit(1)), F.count("redemptions")
    return joined.groupBy("campaign_type", "segment").agg(
        rows.alias("household_campaign_exposures"),
        hits.alias("redeemed_exposures"),
        positive_ratio(hits, rows).alias("redemption_rate"),
    )


def campaign_prepost(tx: DataFrame, exposures: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Spend 28 days before against spend until 28 days after the campaign, per household and type.

    The second window is longer than the first by the campaign's length, so the change is descriptive only; the bias
    comparison has equal windows.
    """
    dated = exposures.join(
        campaigns.select("campaign", F.col("description").alias("campaign_type"), "start_day", "end_day"), "campaign"
    )
    daily = household_day_spend(tx, exposures)
    start = F.col("start_day")
    # a campaign without an end, or with one before its start, has no second window
    last = F.greatest(F.col("end_day") + WINDOW_DAYS, start - 1)
    probes = _window_probes(dated, {"pre": (start - WINDOW_DAYS, start - 1), "post": (start, last)})
    per_household = (
        totals_upto(daily, probes)
        .groupBy("campaign_type", "household_key")
        .agg(_signed("pre", "spend_upto").alias("pre_u"), _signed("post", "spend_upto").alias("post_u"))
    )
    rows = F.count(F.lit(1))
    return per_household.groupBy("campaign_type").agg(
        rows.alias("households"),
        mean_money(wide_sum("pre_u"), rows).alias("avg_pre_spend"),
        mean_money(wide_sum("post_u"), rows).alias("avg_post_spend"),
        mean_money(wide_sum(F.col("post_u") - F.col("pre_u")), rows).alias("avg_change"),
    )
