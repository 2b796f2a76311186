"""Data-quality rules.

Measures are taken with one aggregation per table and grain, stacked into ``(metric, value)`` rows and turned back into
one wide row; every check is an expression over that row. Distinct counts run on tables already reduced to their keys.
Sums over all lines need no grain and no shuffle. Groups of measures are written one after the other, so that the shuffles
of one group are gone before those of the next are made.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmart.functions.money import discount_units, positive_ratio, units, wide_sum, wide_units
from basketmart.functions.timegrid import period_of_day, period_of_week
from basketmart.operators.ordering import rows_above_quantile
from basketmart.plans.categories import CATEGORY, SMALL_GROUP_HOUSEHOLDS
from basketmart.plans.customers import household_totals
from basketmart.plans.features import LABELS
from basketmart.plans.promotion import GRAIN
from basketmart.session import stored

TOLERANCE = 0.01
SUSPICIOUS_QUANTITY = 100
RECEIPT_LINE = [
    "household_key",
    "basket_id",
    "day",
    "week_no",
    "product_id",
    "quantity",
    "sales_value",
    "store_id",
    "retail_disc_signed",
    "coupon_disc_signed",
    "coupon_match_disc_signed",
    "trans_time",
]




def _stacked(frame: DataFrame, names: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{name}', `{name}`" for name in names)
    return frame.selectExpr(f"stack({len(names)}, {pairs}) as (metric, value)")


def measured(frame: DataFrame, **measures: Column) -> DataFrame:
    """One aggregation, stacked into metric rows."""
    return _stacked(frame.agg(*[m.cast("double").alias(name) for name, m in measures.items()]), list(measures))


def gathered(parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """All metric rows as one wide row; a metric without a value counts as 0."""
    rows = reduce(DataFrame.unionByName, [part for part, _ in parts])
    names = [name for _, metrics in parts for name in metrics]
    return rows.groupBy().agg(
        *[F.coalesce(F.max(F.when(F.col("metric") == n, F.col("value"))), F.lit(0.0)).alias(n) for n in names]
    )


def as_checks(wide: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Evaluate the checks on the wide row: counts as whole numbers, conditions as ``true`` or ``false``."""
    row = wide.select(*[check.cast("string").alias(name) for name, check in checks.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in checks)
    return row.selectExpr(f"stack({len(checks)}, {pairs}) as (check_name, check_value)")


class _Measures:
    """Collects measured tables and their metric names."""

    def __init__(self):
        self.parts: list[tuple[DataFrame, list[str]]] = []

    def add(self, frame: DataFrame, **measures: Column) -> None:
        self.parts.append((measured(frame, **measures), list(measures)))

    def add_rows(self, rows: DataFrame, names: list[str]) -> None:
        self.parts.append((rows.select("metric", F.col("value").cast("double").alias("value")), names))

    def settle(self) -> None:
        """Write the measures taken so far, a few rows: all of them are evaluated now, in one job."""
        rows = stored(reduce(DataFrame.unionByName, [part for part, _ in self.parts]))
        self.parts = [(rows, [name for _, names in self.parts for name in names])]

    def wide(self) -> DataFrame:
        return gathered(self.parts)


def _count() -> Column:
    return F.count(F.lit(1))


def repeated_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that others equal in all the columns, one for each set of them, with their number ``n``.

    Equal rows have equal hashes, so a first shuffle carries hashes only; rows whose hash occurs once are equal to no other.
    The rest, compared by all their columns, are few unless the table is listed twice.
    """
    code = F.xxhash64(*columns).alias("_code")
    several = stored(rows.select(code).groupBy("_code").agg(_count().alias("n")).filter("n > 1").select("_code"))
    likely = rows.select(code, *columns).join(several, "_code", "left_semi")
    return likely.groupBy("_code", *columns).agg(_count().alias("n")).filter("n > 1").drop("_code")


def _measure_transactions(m: _Measures, tx: DataFrame) -> None:
    sales, discount = units("sales_value"), discount_units()
    m.add(
        tx,
        tx_lines=_count(),
        tx_sales_u=wide_sum(sales),
        tx_quantity=F.sum("quantity"),
        tx_negative_sales=F.count_if(F.col("sales_value") < 0),
        tx_zero_sales=F.count_if(F.col("sales_value") == 0),
        tx_negative_quantity=F.count_if(F.col("quantity") < 0),
        tx_zero_quantity=F.count_if(F.col("quantity") == 0),
        tx_large_quantity=F.count_if(F.col("quantity") > SUSPICIOUS_QUANTITY),
        tx_invalid_time=F.count_if(F.col("trans_hour").isNull()),
        tx_deep_discount=F.count_if((discount > sales) & (sales > 0)),
        tx_min_day=F.min("day"),
        tx_max_day=F.max("day"),
        tx_min_week=F.min("week_no"),
        tx_max_week=F.max("week_no"),
    )
    keys = {"baskets": "basket_id", "stores": "store_id", "days": "day", "weeks": "week_no"}
    for name, key in keys.items():
        m.add(tx.select(key).distinct(), **{f"tx_{name}": F.count(key)})
    m.settle()
    m.add(repeated_rows(tx, RECEIPT_LINE), tx_repeated=F.sum(F.col("n") - 1))
    m.settle()
    m.add(tx.select(*GRAIN).distinct(), tx_product_store_weeks=_count())
    m.settle()


def _measure_products(m: _Measures, tx: DataFrame, products: DataFrame) -> None:
    """A join is checked for fan-out at product grain: each product's lines times its number of metadata rows."""
    copies = products.groupBy("product_id").agg(_count().alias("copies"))
    sold = tx.groupBy("product_id").agg(_count().alias("lines"), F.sum(units("sales_value")).alias("sales_u"))
    times = F.coalesce("copies", F.lit(1))
    m.add(
        sold.join(copies, "product_id", "left"),
        sold_products=F.count("product_id"),
        joined_lines=F.sum(F.col("lines") * times),
        joined_sales_u=wide_sum(F.col("sales_u") * times),
        unlisted_lines=F.sum(F.when(F.col("copies").isNull(), F.col("lines"))),
    )
    label = F.col("commodity_desc")
    m.add(
        products,
        product_rows=_count(),
        product_keys=F.count_distinct("product_id"),
        blank_labels=F.count_if(label.isNull() | (F.trim(label) == "")),
        label_spellings=F.count_distinct(label),
        label_meanings=F.count_distinct(F.upper(F.trim(label))),
    )


def _measure_marketing(m: _Measures, s: Mapping[str, DataFrame]) -> None:
    campaigns, exposures, redemptions, coupons = (
        s[name] for name in ("campaigns", "exposures", "redemptions", "coupons")
    )
    listed = campaigns.select("campaign").distinct()
    m.add(campaigns, campaigns=F.count_distinct("campaign"))
    pairs = exposures.groupBy("household_key", "campaign").agg(_count().alias("n"))
    m.add(
        pairs,
        exposure_rows=F.sum("n"),
        exposure_pairs=_count(),
        exposed_households=F.count_distinct("household_key"),
    )
    undescribed = exposures.groupBy("campaign").agg(_count().alias("n")).join(listed, "campaign", "left_anti")
    m.add(undescribed, undescribed_exposures=F.sum("n"))
    bridge = coupons.groupBy("campaign", "coupon_upc", "product_id").agg(_count().alias("n"))
    m.add(bridge, coupon_rows=F.sum("n"), coupon_keys=_count(), coupon_upcs=F.count_distinct("coupon_upc"))
    redeemed = redemptions.groupBy("campaign", "coupon_upc").agg(_count().alias("n"))
    m.add(redeemed, redemption_rows=F.sum("n"))
    m.add(redeemed.join(listed, "campaign", "left_anti"), undescribed_redemptions=F.sum("n"))
    context = coupons.select("campaign", "coupon_upc").distinct()
    m.add(redeemed.join(context, ["campaign", "coupon_upc"], "left_anti"), unknown_coupons=F.sum("n"))
    shelf = s["merchandising"].groupBy(*GRAIN).agg(_count().alias("n"))
    m.add(shelf, merchandising_rows=F.sum("n"), merchandising_keys=_count())


def _measure_coverage(m: _Measures, tx: DataFrame, households: DataFrame) -> None:
    buyers = tx.select("household_key").filter(F.col("household_key").isNotNull()).distinct()
    known = households.select("household_key")
    m.add(buyers, tx_households=_count())
    m.add(buyers.join(known, "household_key", "left_semi"), covered_households=_count())
    m.add(buyers.join(known, "household_key", "left_anti"), uncovered_households=_count())


def _measure_marts(m: _Measures, marts: Mapping[str, DataFrame]) -> None:
    baskets = marts["mart_baskets"]
    rate = F.col("discount_rate")
    m.add(
        baskets.groupBy("basket_id").agg(
            _count().alias("n"),
            F.sum(units("basket_spend")).alias("spend_u"),
            F.sum("basket_units").alias("basket_units"),
            F.count_if((rate < 0) | (rate > 1)).alias("out_of_range"),
        ),
        basket_rows=F.sum("n"),
        basket_keys=F.count("basket_id"),
        basket_spend_u=wide_sum("spend_u"),
        basket_units=F.sum("basket_units"),
        basket_rates_out_of_range=F.sum("out_of_range"),
    )
    periods = marts["mart_household_period"].groupBy("household_key", "period_id").agg(_count().alias("n"))
    m.add(periods, period_rows=F.sum("n"), period_keys=_count())
    m.settle()
    m.add(
        marts["mart_promotion_performance"],
        promotion_rows=F.sum("product_store_weeks"),
        promotion_sales_u=F.sum(wide_units("sales")),
        promotion_units=F.sum("units"),
    )
    m.settle()
    m.add(marts["mart_categories"], sparse_categories=F.count_if(F.col("household_count") < SMALL_GROUP_HOUSEHOLDS))
    m.settle()
    # the three distributions share one histogram pass
    values = (
        baskets.select(F.col("basket_spend").alias("outlier_baskets"))
        .unionByName(
            household_totals(baskets).select((F.col("spend_u") / 10000.0).alias("outlier_households")),
            allowMissingColumns=True,
        )
        .unionByName(
            marts["mart_products"].select(F.col("product_sales").alias("outlier_products")), allowMissingColumns=True
        )
    )
    outliers = rows_above_quantile(values, {name: F.col(name) for name in values.columns}, 0.99)
    m.add_rows(outliers.select(F.col("series").alias("metric"), F.col("rows").alias("value")), values.columns)


def _whole(column: Column) -> Column:
    return column.cast("long")


def _reconciles(left: str, right: str, scale: float = 1.0) -> Column:
    return F.abs(F.col(left) - F.col(right)) / scale < TOLERANCE


def _definitions() -> dict[str, Column]:
    """The published checks in their published order."""
    c = F.col
    counts = {
        "transaction_rows": c("tx_lines"),
        "distinct_baskets": c("tx_baskets"),
        "distinct_households": c("tx_households"),
        "distinct_products": c("sold_products"),
        "distinct_stores": c("tx_stores"),
        "campaign_count": c("campaigns"),
        "exposed_households": c("exposed_households"),
        "coupon_count": c("coupon_upcs"),
        "coupon_redemption_rows": c("redemption_rows"),
        "causal_source_rows": c("merchandising_rows"),
        "min_day": c("tx_min_day"),
        "max_day": c("tx_max_day"),
        "min_week": c("tx_min_week"),
        "max_week": c("tx_max_week"),
        "mart_basket_rows": c("basket_rows"),
        "products_duplicate_keys": c("product_rows") - c("product_keys"),
        "campaign_exposure_duplicate_keys": c("exposure_rows") - c("exposure_pairs"),
        "coupon_bridge_duplicate_rows": c("coupon_rows") - c("coupon_keys"),
        "causal_duplicate_exact_keys": c("merchandising_rows") - c("merchandising_keys"),
        "transactions_missing_product_metadata": c("unlisted_lines"),
        "campaign_exposures_missing_description": c("undescribed_exposures"),
        "redemptions_missing_campaign": c("undescribed_redemptions"),
        "negative_sales_rows": c("tx_negative_sales"),
        "zero_sales_rows": c("tx_zero_sales"),
        "negative_quantity_rows": c("tx_negative_quantity"),
        "zero_quantity_rows": c("tx_zero_quantity"),
        "invalid_trans_time_rows": c("tx_invalid_time"),
        "discount_larger_than_net_sales_rows": c("tx_deep_discount"),
        "coupon_product_bridge_distinct_rows": c("coupon_keys"),
        "causal_exact_key_rows": c("merchandising_keys"),
        "transaction_product_store_week_rows": c("tx_product_store_weeks"),
        "promotion_join_rows": c("promotion_rows"),
        "duplicate_transaction_rows": c("tx_repeated"),
        "demographic_covered_households": c("covered_households"),
        "demographic_uncovered_households": c("uncovered_households"),
        "redemptions_missing_coupon_context": c("unknown_coupons"),
        "suspicious_quantity_rows_over_100": c("tx_large_quantity"),
        "outlier_baskets_above_p99": c("outlier_baskets"),
        "outlier_households_above_p99_spend": c("outlier_households"),
        "outlier_products_above_p99_sales": c("outlier_products"),
        "day_index_gap_count": c("tx_max_day") - c("tx_min_day") + 1 - c("tx_days"),
        "week_index_gap_count": c("tx_max_week") - c("tx_min_week") + 1 - c("tx_weeks"),
        "sparse_categories_under_50_households": c("sparse_categories"),
        "null_or_blank_category_labels": c("blank_labels"),
        "normalized_category_label_collisions": c("label_spellings") - c("label_meanings"),
    }
    conditions = {
        "basket_fanout_ok": c("basket_rows") == c("basket_keys"),
        "basket_sales_reconciled": _reconciles("tx_sales_u", "basket_spend_u", 10000.0),
        "basket_units_reconciled": _reconciles("tx_quantity", "basket_units"),
        "household_period_unique": c("period_rows") == c("period_keys"),
        "product_join_fanout_ok": c("tx_lines") == c("joined_lines"),
        "product_join_sales_reconciled": _reconciles("tx_sales_u", "joined_sales_u", 10000.0),
        "promotion_join_fanout_ok": c("tx_product_store_weeks") == c("promotion_rows"),
        "promotion_join_sales_reconciled": _reconciles("tx_sales_u", "promotion_sales_u", 10000.0),
        "promotion_join_units_reconciled": _reconciles("tx_quantity", "promotion_units"),
        "basket_discount_rate_in_range": c("basket_rates_out_of_range") == 0,
    }
    return {**{name: _whole(value) for name, value in counts.items()}, **conditions}


def validation_checks(s: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]) -> DataFrame:
    """The 55 published checks as ``(check_name, check_value)``."""
    m = _Measures()
    tx = s["transactions"]
    _measure_transactions(m, tx)
    _measure_products(m, tx, s["products"])
    m.settle()
    _measure_marketing(m, s)
    m.settle()
    _measure_coverage(m, tx, s["households"])
    m.settle()
    _measure_marts(m, marts)
    return as_checks(m.wide(), _definitions())


def legacy_discount_check(tx: DataFrame) -> DataFrame:
    """The superseded rule: discounts above net sales plus retail discount."""
    sales = units("sales_value")
    deep = (discount_units() > sales + units("retail_discount_amt")) & (sales > 0)
    m = _Measures()
    m.add(tx, deep_discount=F.count_if(deep))
    return as_checks(m.wide(), {"discount_larger_than_sales_rows": _whole(F.col("deep_discount"))})


def source_checks(s: Mapping[str, DataFrame]) -> DataFrame:
    """Every source holds rows; bridges have no fewer rows than keys; time indexes keep to their bounds."""
    m = _Measures()
    names = list(s)
    for name in names:
        m.add(s[name], **{f"rows_{name}": _count()})
    tx = s["transactions"]
    m.add(
        tx,
        low_day=F.min("day"),
        high_day=F.max("day"),
        low_week=F.min("week_no"),
        high_week=F.max("week_no"),
        bad_clock=F.count_if(F.col("trans_time").isNotNull() & F.col("trans_hour").isNull()),
        misaligned=F.count_if(period_of_week("week_no") != period_of_day("day")),
        finer_than_money=F.count_if(F.abs(F.col("sales_value") * 10000 - units("sales_value")) > 0.001),
    )
    m.add(s["coupons"].groupBy("campaign", "coupon_upc", "product_id").count(), coupon_keys=_count())
    m.add(s["merchandising"].groupBy(*GRAIN).count(), merchandising_keys=_count())
    c = F.col
    checks = {f"{name}_not_empty": c(f"rows_{name}") > 0 for name in names}
    checks |= {
        "coupon_keys_within_rows": c("coupon_keys") <= c("rows_coupons"),
        "merchandising_keys_within_rows": c("merchandising_keys") <= c("rows_merchandising"),
        "first_day": _whole(c("low_day")),
        "last_day": _whole(c("high_day")),
        "first_week": _whole(c("low_week")),
        "last_week": _whole(c("high_week")),
        "invalid_clock_rows": _whole(c("bad_clock")),
        "week_and_day_period_mismatch_rows": _whole(c("misaligned")),
        "amounts_finer_than_four_decimals": _whole(c("finer_than_money")),
    }
    return as_checks(m.wide(), checks)


def _outside(column: str) -> Column:
    return F.count_if((F.col(column) < 0) | (F.col(column) > 1))


def _not_in(column: str, allowed: list) -> Column:
    return F.count_if(~F.col(column).isin(allowed))


def invariant_checks(s: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]) -> DataFrame:
    """Properties every mart must have, as ``true`` or ``false``."""
    m = _Measures()
    periods = marts["mart_household_period"]
    by_household = periods.groupBy("household_key").agg(
        _count().alias("n"),
        F.count_distinct("period_id").alias("distinct_periods"),
        F.sum("incomplete_period_flag").alias("incomplete"),
        F.count_if((F.col("period_id") == 1) & F.col("prior_period_spend").isNotNull()).alias("early_prior"),
        _not_in("active_flag", [0, 1]).alias("bad_active"),
    )
    m.add(
        by_household,
        spine_rows=F.sum("n"),
        spine_keys=F.sum("distinct_periods"),
        spine_households=_count(),
        spine_periods=F.max("distinct_periods"),
        not_one_incomplete=F.count_if(F.col("incomplete") != 1),
        early_prior=F.sum("early_prior"),
        bad_active=F.sum("bad_active"),
    )
    baskets = marts["mart_baskets"]
    discounts = F.col("total_retail_discount") + F.col("total_coupon_discount") + F.col("total_coupon_match_discount")
    expected_rate = positive_ratio(discounts, F.col("gross_sales"))
    m.add(
        baskets,
        negative_discounts=F.count_if(discounts < 0),
        gross_off=F.count_if(F.abs(F.col("basket_spend") + discounts - F.col("gross_sales")) >= TOLERANCE),
        rate_off=F.count_if(F.abs(expected_rate - F.col("discount_rate")) >= 1e-10),
        bad_coupon_flag=_not_in("coupon_used_flag", [0, 1]),
    )
    m.add(
        baskets.groupBy("basket_id").agg(F.sum(units("basket_spend")).alias("u"), F.sum("basket_units").alias("q")),
        mart_baskets=_count(),
        mart_spend=F.round(wide_sum("u") / 10000.0, 2),
        mart_units=F.round(F.sum("q"), 2),
    )
    raw = s["transactions"].groupBy("basket_id").agg(F.sum(units("sales_value")).alias("u"), F.sum("quantity").alias("q"))
    m.add(
        raw, raw_baskets=_count(), raw_spend=F.round(wide_sum("u") / 10000.0, 2), raw_units=F.round(F.sum("q"), 2)
    )
    campaigns = marts["mart_campaigns"]
    m.add(
        campaigns,
        campaign_rates=_outside("household_redemption_rate"),
        campaign_types=_not_in("campaign_type", ["TypeA", "TypeB", "TypeC"]),
    )
    categories = marts["mart_categories"]
    m.add(
        categories,
        category_rates=_outside("household_penetration") + _outside("basket_penetration") + _outside("discount_rate"),
    )
    m.add(categories.groupBy(*CATEGORY).count(), repeated_categories=F.count_if(F.col("count") > 1))
    m.add(
        marts["mart_products"].groupBy("product_id").count(), repeated_products=F.count_if(F.col("count") > 1)
    )
    m.add(
        marts["campaign_segment_analysis"],
        segment_rates=_outside("redemption_rate"),
        segment_excess=F.count_if(F.col("redeemed_exposures") > F.col("household_campaign_exposures")),
    )
    m.add(
        marts["campaign_bias_comparison"],
        bad_quartiles=_not_in("prior_value_quartile", [1, 2, 3, 4]),
        bad_redeemed=_not_in("redeemed_flag", [0, 1]),
        empty_strata=F.count_if(F.col("household_campaign_exposures") <= 0),
    )
    m.add(
        marts["customer_period_summary"],
        summary_rates=_outside("retention_rate"),
        summary_excess=F.count_if(F.col("retained_households") > F.col("prior_active_households")),
        summary_repeats=_count() - F.count_distinct("period_id"),
    )
    m.add(
        marts["customer_retention_matrix"],
        matrix_rates=_outside("retention_rate"),
        matrix_excess=F.count_if(F.col("active_households") > F.col("cohort_households")),
    )
    m.add(
        marts["mart_promotion_performance"], bad_status=_not_in("promotion_status", ["promoted", "not_promoted"])
    )
    features = marts["mart_customer_features"]
    numeric = [name for name, kind in features.dtypes if kind == "double"]
    infinite = [F.isnan(name) | F.abs(F.col(name)).isin(float("inf")) for name in numeric]
    m.add(
        features.groupBy("household_key").agg(
            _count().alias("n"), F.count_if(reduce(Column.__or__, infinite)).alias("infinite")
        ),
        repeated_features=F.count_if(F.col("n") > 1),
        infinite_features=F.sum("infinite"),
    )
    predictors = [name for name in features.columns if name not in LABELS]
    leaking = [name for name in predictors if name.startswith(("future", "next_period"))]
    c = F.col
    none = {
        "period_one_has_no_prior": ["early_prior"],
        "one_incomplete_period_per_household": ["not_one_incomplete"],
        "discounts_not_negative": ["negative_discounts"],
        "gross_is_net_plus_discounts": ["gross_off"],
        "discount_rate_is_discounts_over_gross": ["rate_off"],
        "flags_are_binary": ["bad_active", "bad_coupon_flag", "bad_redeemed"],
        "rates_within_unit_interval": [
            "campaign_rates",
            "category_rates",
            "segment_rates",
            "summary_rates",
            "matrix_rates",
        ],
        "retained_within_prior_active": ["summary_excess"],
        "active_within_cohort": ["matrix_excess"],
        "redeemed_within_exposed": ["segment_excess"],
        "mart_keys_unique": ["repeated_categories", "repeated_products", "summary_repeats", "repeated_features"],
        "campaign_types_known": ["campaign_types"],
        "quartiles_known": ["bad_quartiles", "empty_strata"],
        "promotion_statuses_known": ["bad_status"],
        "numeric_features_finite": ["infinite_features"],
    }
    checks = {
        "spine_complete": (c("spine_rows") == c("spine_households") * c("spine_periods"))
        & (c("spine_rows") == c("spine_keys")),
        **{name: reduce(Column.__add__, [c(metric) for metric in metrics]) == 0 for name, metrics in none.items()},
        "no_label_among_features": F.lit(not leaking),
        "basket_mart_matches_source": (c("mart_baskets") == c("raw_baskets"))
        & (c("mart_spend") == c("raw_spend"))
        & (c("mart_units") == c("raw_units")),
    }
    return as_checks(m.wide(), checks)
