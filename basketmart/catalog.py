"""Registry of the queries: each takes a session and a folder of parquet tables and returns a DataFrame.

Results are rounded here, and only here: money to 2 decimals, most average money to 4, rates to 6.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.functions.money import money
from basketmart.functions.pvalues import normal_p, student_p
from basketmart.operators import ordering as O
from basketmart.plans import baskets as B
from basketmart.plans import campaigns as K
from basketmart.plans import categories as C
from basketmart.plans import chart_data as D
from basketmart.plans import components as A
from basketmart.plans import customers as U
from basketmart.plans import household_period as H
from basketmart.plans import kpi_contract as N
from basketmart.plans import matrix as M
from basketmart.plans import model as L
from basketmart.plans import features as X
from basketmart.plans import products as P
from basketmart.plans import promotion as R
from basketmart.plans import similarity as S
from basketmart.plans import statistics as T
from basketmart.plans import validation as V
from basketmart.plans import warehouse
from basketmart.plans.staging import stage_all, stage_transactions
from basketmart.session import scratch_path, stored, tune
from basketmart.sources.csv import read_source
from basketmart.sources.sinks import export_csv
from basketmart.sources.star import fingerprint, star_sources
from basketmart.sources.tables import LazyTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


# Staged tables the adapter derives from a join of large inputs.
DERIVED_FROM = {
    "transactions": ("lineitem", "orders"),
    "merchandising": ("lineitem", "orders"),
    "redemptions": ("lineitem", "orders", "customer", "nation"),
    "stored_baskets": ("lineitem", "orders"),
    "stored_periods": ("lineitem", "orders", "part", "customer", "nation"),
    "stored_cells": ("lineitem", "orders", "part"),
}
_STORED: dict[tuple, DataFrame] = {}


def _stored_once(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A staged table or shared mart, written once per session and state of its input files.

    Marts read the staged tables, most of them more than once, so they are tables rather than views: deriving them
    again for each reader would repeat a join of the largest inputs. Marts that many queries read are shared likewise.
    """
    key = (spark.sparkContext.applicationId, name, folder, fingerprint(spark, folder, *DERIVED_FROM[name]))
    if key not in _STORED:
        _STORED[key] = stored(build())
    return _STORED[key]


def staged(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """Staged tables of a folder; each is planned when a query asks for it."""
    tune(spark)
    sources = star_sources(spark, folder)
    views = stage_all(sources)

    def build(name: str) -> DataFrame:
        if name == "transactions":
            # stored as read: what staging adds follows from these columns
            return stage_transactions(_stored_once(spark, folder, name, partial(sources.__getitem__, "transaction_data")))
        if name in DERIVED_FROM:
            return _stored_once(spark, folder, name, partial(views.__getitem__, name))
        return views[name]

    tables = LazyTables(
        {name: partial(build, name) for name in views}
        | {RECEIPTS: partial(views.__getitem__, "transactions")}
        | {name: partial(_stored_once, spark, folder, name, lambda make=make: make(tables)) for name, make in SHARED.items()}
    )
    return tables


# The staged lines as a plan, not read back. The adapter joins lines to receipts by the receipt's key, so baskets that are
# put together from the plan need no further shuffle, where those from the stored table need two of all lines.
RECEIPTS = "receipts"

# Marts that several queries read, as plans over the staged tables.
SHARED = {
    "stored_baskets": lambda s: _baskets(s),
    "stored_periods": lambda s: _household_period(s),
    "stored_cells": lambda s: _cells(s),
}


def rounded(frame: DataFrame, **decimals: int | str) -> DataFrame:
    """Round the named columns."""
    return frame.withColumns({name: F.round(name, places) for name, places in decimals.items()})


def query(builder: Callable[[Mapping[str, DataFrame]], DataFrame]):
    """Register a plan over the staged tables under its function name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return builder(staged(spark, folder))

    QUERIES[builder.__name__] = run
    return builder


# --- staging and baskets ---------------------------------------------------------------------------------------------


def stage_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The staged lines as a plan, not read back from the stored table."""
    tune(spark)
    return stage_all(star_sources(spark, folder))["transactions"]


QUERIES["stg_transactions"] = stage_lines


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The receipt lines, exported as CSV under a name that starts with an underscore, read in byte ranges and staged."""
    tune(spark)
    sources = star_sources(spark, folder)
    path = f"{scratch_path(spark)}/_transaction_data.csv"
    export_csv(sources["transaction_data"], path)
    lines = read_source(spark, path, "transaction_data")
    return stage_all(LazyTables({name: partial(sources.__getitem__, name) for name in sources} | {"transaction_data": lambda: lines}))[
        "transactions"
    ]


QUERIES["csv_round_trip"] = csv_round_trip


@query
def receipts_by_hour(s):
    return s["transactions"].groupBy("trans_hour").agg(
        F.count(F.lit(1)).alias("transaction_lines"), F.count_distinct("basket_id").alias("baskets")
    )


def _rounded_baskets(frame: DataFrame, *extra: str) -> DataFrame:
    money_columns = ["basket_spend", "total_retail_discount", "total_coupon_discount", "total_coupon_match_discount"]
    return rounded(frame, **{name: 2 for name in [*money_columns, *extra]}, discount_rate=6)


@query
def mart_baskets(s):
    return _rounded_baskets(_baskets(s), "gross_sales")


@query
def mart_baskets_legacy(s):
    return _rounded_baskets(B.mart_baskets(s[RECEIPTS], legacy_rate=True))


@query
def kpi_summary(s):
    return rounded(
        B.kpi_summary(_baskets(s)),
        spend=2,
        avg_basket_value=4,
        avg_basket_size=6,
        discount_amount=2,
        coupon_basket_rate=6,
    )


# --- products and categories -----------------------------------------------------------------------------------------


def _baskets(s):
    return B.mart_baskets(s[RECEIPTS])


def _categories(s):
    return C.mart_categories(s["transactions"], s["products"])


def _category_periods(s):
    return C.mart_category_period(s["transactions"], s["products"])


def _diagnostics(s):
    return C.mart_category_diagnostics(_categories(s), _category_periods(s))


def _rounded_products(frame: DataFrame, **extra: int) -> DataFrame:
    return rounded(
        frame,
        product_sales=2,
        basket_penetration=6,
        household_penetration=6,
        discount_rate=6,
        sales_growth=2,
        **extra,
    )


@query
def mart_products(s):
    return _rounded_products(P.mart_products(s["transactions"], s["products"]), sales_growth_rate=6)


@query
def mart_products_legacy(s):
    return _rounded_products(P.mart_products(s["transactions"], s["products"], legacy=True))


CATEGORY_ROUNDING = {
    "category_sales": 2,
    "household_penetration": 6,
    "basket_penetration": 6,
    "discount_rate": 6,
    "first_year_sales": 2,
    "second_year_sales": 2,
    "sales_growth": 2,
}


@query
def mart_categories(s):
    return rounded(_categories(s), **CATEGORY_ROUNDING, sales_growth_rate=6)


@query
def mart_categories_legacy(s):
    return rounded(C.mart_categories(s["transactions"], s["products"], legacy=True), **CATEGORY_ROUNDING)


@query
def mart_category_period(s):
    return rounded(_category_periods(s), sales=2)


@query
def mart_category_diagnostics(s):
    return rounded(
        _diagnostics(s),
        **CATEGORY_ROUNDING,
        sales_growth_rate=6,
        mean_period_sales=6,
        sd_period_sales=2,
        sales_coefficient_of_variation=6,
    )


@query
def category_top15(s):
    columns = [
        "department",
        "commodity_desc",
        "category_sales",
        "household_count",
        "household_penetration",
        "sales_growth",
        "sales_growth_rate",
        "sales_coefficient_of_variation",
        "household_engagement_change",
        "high_sales_declining_flag",
    ]
    top = C.top_categories(_diagnostics(s), "category_sales", 15, 50).select(*columns)
    return rounded(
        top,
        category_sales=2,
        household_penetration=6,
        sales_growth=2,
        sales_growth_rate=6,
        sales_coefficient_of_variation=6,
    )


@query
def category_top10(s):
    columns = ["commodity_desc", "category_sales", "household_penetration", "discount_rate", "sales_growth"]
    top = C.top_categories(_categories(s), "category_sales", 10, 50).select(*columns)
    return rounded(top, category_sales=2, household_penetration=6, discount_rate=6, sales_growth=2)


@query
def category_growth_leaders(s):
    columns = ["commodity_desc", "first_year_sales", "second_year_sales", "sales_growth", "household_penetration"]
    top = C.top_categories(_categories(s), "sales_growth", 10, 100).select(*columns)
    return rounded(top, first_year_sales=2, second_year_sales=2, sales_growth=2, household_penetration=6)


# --- household periods and customers ---------------------------------------------------------------------------------


def _stored_baskets(s):
    """Basket mart for plans that read it more than once."""
    return s["stored_baskets"]


def _period_inputs(s):
    return (_stored_baskets(s), s["transactions"], s["products"], s["exposures"], s["campaigns"], s["redemptions"])


def _household_period(s):
    return H.mart_household_period(*_period_inputs(s))


PERIOD_ROUNDING = {
    "total_spend": 2,
    "average_basket_value": 4,
    "average_basket_size": 6,
    "total_discount": 2,
    "discount_rate": 6,
    "prior_period_spend": 2,
    "spend_change": 2,
}


@query
def mart_household_period(s):
    return rounded(_household_period(s), **PERIOD_ROUNDING)


@query
def mart_household_period_active(s):
    return rounded(H.mart_household_period_active(*_period_inputs(s)), **PERIOD_ROUNDING)


@query
def customer_period_summary(s):
    return rounded(H.customer_period_summary(_stored_periods(s)), retention_rate=6)


@query
def customer_retention_matrix(s):
    return rounded(H.customer_retention_matrix(_stored_periods(s)), retention_rate=6)


@query
def dropped_events(s):
    return H.dropped_events(H.household_spine(_stored_baskets(s)), s["exposures"], s["campaigns"], s["redemptions"])


@query
def household_spine(s):
    return H.household_spine(_stored_baskets(s))


@query
def period_series(s):
    return H.period_series(_stored_baskets(s))


@query
def customer_segments(s):
    return U.customer_segments(_stored_baskets(s))


@query
def value_concentration(s):
    return rounded(U.value_concentration(_stored_baskets(s)), spend=2, cumulative_share=6)


# --- campaigns, coupons and promotions -------------------------------------------------------------------------------


def _campaigns(s):
    return K.mart_campaigns(s["campaigns"], s["exposures"], s["redemptions"])


@query
def mart_campaigns(s):
    return rounded(_campaigns(s), household_redemption_rate=6)


@query
def campaign_funnel_top10(s):
    return rounded(K.campaign_funnel(_campaigns(s)), household_redemption_rate=6)


@query
def mart_coupon_redemptions(s):
    return K.mart_coupon_redemptions(s["redemptions"], s["campaigns"])


@query
def campaign_bias_comparison(s):
    frame = K.campaign_bias_comparison(s["transactions"], s["exposures"], s["campaigns"], s["redemptions"])
    return rounded(
        frame,
        avg_pre_spend=4,
        avg_post_spend=4,
        avg_spend_change=4,
        avg_pre_baskets=6,
        avg_post_baskets=6,
        avg_basket_change=6,
    )


@query
def campaign_segment_analysis(s):
    segments = U.household_segments(_stored_baskets(s))
    frame = K.campaign_segment_analysis(segments, s["exposures"], s["campaigns"], s["redemptions"])
    return rounded(frame, redemption_rate=6)


@query
def campaign_prepost(s):
    frame = K.campaign_prepost(s["transactions"], s["exposures"], s["campaigns"])
    return rounded(frame, avg_pre_spend=2, avg_post_spend=2, avg_change=2)


@query
def mart_promotion_performance(s):
    frame = R.mart_promotion_performance(s["transactions"], s["merchandising"])
    return rounded(frame, sales=2, avg_sales_per_product_store_week=4)


# --- features and checks ---------------------------------------------------------------------------------------------


def _features(s):
    return X.mart_customer_features(
        s["transactions"], s["products"], s["exposures"], s["campaigns"], s["households"]
    )


FEATURE_ROUNDING = {
    "monetary_spend": 2,
    "discount_amount": 2,
    "first_half_spend": 2,
    "second_half_spend": 2,
    "top_department_share": 6,
    "spend_trend_change": 2,
    "discount_rate": 6,
    "coupon_engagement": 6,
    "future_spend": 2,
}


@query
def mart_customer_features(s):
    return rounded(_features(s), **FEATURE_ROUNDING)


def _marts(s, *kept: str):
    """All marts; the ones read more than once are stored, the others keep being pruned to what is read of them."""
    shared = {"mart_baskets": "stored_baskets", "mart_household_period": "stored_periods"}

    def keep(name, frame):
        if name in shared:
            return s[shared[name]]
        return stored(frame) if name in kept else frame

    return warehouse.marts(s, keep=keep)


@query
def validation_checks(s):
    return V.validation_checks(s, _marts(s, "mart_baskets"))


@query
def legacy_discount_check(s):
    return V.legacy_discount_check(s["transactions"])


@query
def source_checks(s):
    return V.source_checks(LazyTables({name: partial(s.__getitem__, name) for name in s if name not in {*SHARED, RECEIPTS}}))


@query
def invariant_checks(s):
    return V.invariant_checks(s, _marts(s, "mart_baskets", "mart_household_period", "mart_categories"))


@query
def kpi_support(s):
    return N.kpi_support(_marts(s, "mart_baskets", "mart_household_period", "mart_categories"))


# --- statistics ------------------------------------------------------------------------------------------------------


def _stored_periods(s):
    return s["stored_periods"]


def nine_digits(column: str):
    """A double with nine significant digits, for values whose size differs by many orders of magnitude."""
    return F.format_string("%.8e", F.col(column)).cast("double")


@query
def basket_descriptives(s):
    return rounded(
        T.basket_descriptives(_stored_baskets(s)),
        mean_basket_spend=4,
        median_basket_spend=4,
        sd_basket_spend=2,
        mean_basket_units=6,
        median_basket_units=4,
        mean_discount_rate=6,
        median_discount_rate=6,
    )


@query
def event_probabilities(s):
    inputs = _period_inputs(s)
    summary = H.customer_period_summary(H.mart_household_period(*inputs))
    frame = T.event_probabilities(inputs[0], summary)
    return rounded(frame, **{name: 6 for name in frame.columns})


@query
def bootstrap_ci(s):
    return rounded(T.bootstrap_ci(_stored_baskets(s)), lower=3, upper=3)


@query
def welch_spend(s):
    return rounded(
        T.welch_spend(_stored_periods(s)), early_mean=4, late_mean=4, t_statistic=6, degrees_of_freedom=3
    )


@query
def cohens_d(s):
    return rounded(T.cohens_d(_stored_periods(s)), late_minus_early_d=6)


@query
def mann_whitney_discount(s):
    return rounded(T.mann_whitney_discount(_categories(s)), z_score=6)


@query
def rank_biserial(s):
    return rounded(T.rank_biserial(_categories(s)), rank_biserial=6)


@query
def hypothesis_p_values(s):
    welch = T.welch_spend(_stored_periods(s)).select(
        F.lit("welch_spend").alias("test"), F.round(student_p("t_statistic", "degrees_of_freedom"), 4).alias("p_value")
    )
    ranks = T.mann_whitney_discount(_categories(s)).select(
        F.lit("mann_whitney_discount").alias("test"), F.round(normal_p("z_score"), 4).alias("p_value")
    )
    return welch.unionByName(ranks)


@query
def basket_spearman(s):
    return rounded(T.basket_spearman(_stored_baskets(s)), rho=6)


@query
def basket_covariance(s):
    return T.basket_covariance(_stored_baskets(s)).withColumn("covariance", nine_digits("covariance"))


@query
def experiment_mde(s):
    return rounded(T.experiment_mde(_stored_periods(s)), mde_spend=2, mde_percent=2)


@query
def sample_size_by_lift(s):
    return T.sample_size_by_lift(_stored_baskets(s))


# --- figures ---------------------------------------------------------------------------------------------------------


@query
def baskets_by_week(s):
    return B.baskets_by_week(s["transactions"])


@query
def basket_spend_hist(s):
    return rounded(D.basket_spend_histogram(_stored_baskets(s)), bin_start=2)


@query
def basket_freq_hist(s):
    return rounded(D.basket_frequency_histogram(_stored_periods(s)), bin_start=6)


@query
def retention_pivot(s):
    matrix = stored(H.customer_retention_matrix(_stored_periods(s)))
    last = matrix.agg(F.max("period_id")).first()[0]
    frame = D.retention_pivot(matrix, last)
    return rounded(frame, **{name: 6 for name in frame.columns if name != "cohort_period"})


@query
def category_points(s):
    return rounded(
        D.category_points(_categories(s)), household_penetration=6, category_sales=2, sales_growth=2, discount_rate=6
    )


@query
def discount_sales_fit(s):
    return D.discount_sales_fit(_categories(s)).select(
        nine_digits("slope").alias("slope"), nine_digits("intercept").alias("intercept")
    )


@query
def first_campaigns(s):
    return D.first_campaigns(_campaigns(s))


# --- matrix and model ------------------------------------------------------------------------------------------------


def _cells(s):
    return M.spend_cells(s["transactions"], s["products"])


@query
def spend_matrix_cells(s):
    return _cells(s).select("household_key", "commodity_desc", F.round(money("spend_u"), 2).alias("spend"))


@query
def matrix_profile(s):
    return rounded(M.matrix_profile(s["stored_cells"]), sparsity=4)


@query
def nearest_households(s):
    return rounded(M.nearest_households(s["stored_cells"]), cosine_similarity=4)


@query
def nearest_households_all(s):
    return rounded(S.nearest_households_all(s["stored_cells"]), cosine_similarity=4)


@query
def nearest_to_first_household(s):
    return rounded(M.nearest_to_first_household(s["stored_cells"]), cosine_similarity=4)


@query
def pca_variance(s):
    return rounded(A.pca_variance(s["stored_cells"]), variance_share=4, cumulative_share=4)


@query
def model_holdout(s):
    return L.model_holdout(_features(s))


@query
def model_coefficients(s):
    return rounded(L.model_coefficients(_features(s)), coefficient=6)


@query
def model_split(s):
    return L.model_split(_features(s))


@query
def model_medians(s):
    return rounded(L.model_medians(_features(s)), median=4)


@query
def model_levels(s):
    return L.model_levels(_features(s))


# --- single operators ------------------------------------------------------------------------------------------------


@query
def interval_join(s):
    frame = K.exposure_behaviour(s["transactions"], s["exposures"], s["campaigns"], s["redemptions"])
    return frame.select(
        "household_key",
        "campaign",
        "redeemed_flag",
        F.round(money("pre_u"), 2).alias("pre_spend"),
        F.round(money("post_u"), 2).alias("post_spend"),
        "pre_baskets",
        "post_baskets",
    )


@query
def existence_flag(s):
    redeemed = K.redeemed_pairs(s["redemptions"])
    joined = s["exposures"].join(redeemed, ["household_key", "campaign"], "left")
    return joined.select(
        "household_key", "campaign", F.col("redemptions").isNotNull().cast("int").alias("redeemed_flag")
    )


@query
def missing_product_lines(s):
    lines = s["transactions"].groupBy("product_id").agg(F.count(F.lit(1)).alias("transaction_lines"))
    return lines.join(s["products"], "product_id", "left_anti")


@query
def covered_households(s):
    return s["transactions"].select("household_key").distinct().join(s["households"], "household_key", "left_semi")


@query
def exact_grain_join(s):
    frame = R.promoted_product_store_weeks(s["transactions"], s["merchandising"])
    return frame.select(
        *R.GRAIN, "promotion_status", F.round(money("sales_u"), 2).alias("sales"), "baskets", "transaction_lines"
    )


@query
def deduplicated_bridge(s):
    return R.exact_merchandising(s["merchandising"])


@query
def distinct_tuples(s):
    """Tuples with a NULL field count like any other, so the pair is counted as one struct."""
    tx = s["transactions"]
    return tx.agg(
        F.count_distinct(F.struct("product_id", "coupon_disc_signed")).alias("product_coupon_tuples"),
        F.count_distinct("product_id", "coupon_disc_signed").alias("complete_tuples"),
    )


@query
def product_attributes(s):
    return P.product_attributes(s["products"])


@query
def basket_quantiles(s):
    series = {"basket_spend": F.col("basket_spend"), "basket_units": F.col("basket_units")}
    return rounded(O.exact_quantiles(_stored_baskets(s), series, [0.5, 0.75, 0.99]), quantile=4)


@query
def outliers_above_p99(s):
    series = {"basket_spend": F.col("basket_spend"), "basket_units": F.col("basket_units")}
    return rounded(O.rows_above_quantile(_stored_baskets(s), series, 0.99), quantile=4)


@query
def clipped_basket_spend(s):
    baskets = _stored_baskets(s).select("basket_id", "household_key", "basket_spend")
    return rounded(D.clip_at_quantile(baskets, "basket_spend", 0.99), basket_spend=4)


@query
def average_ranks(s):
    """Basket units and their tied ranks, counted in slices that no frequent value fills alone."""
    baskets = _stored_baskets(s).select("basket_id", "household_key", "basket_units")
    return O.tied_ranks(baskets, "basket_units", {"units_rank": F.lit(True)})


@query
def ntile_global(s):
    return U.household_quartiles(_stored_baskets(s)).select("household_key", "value_quartile")


@query
def ntile_per_campaign(s):
    frame = K.exposure_behaviour(s["transactions"], s["exposures"], s["campaigns"], s["redemptions"])
    tiled = O.ntile(frame, 4, ["pre_u", "household_key"], ["campaign"], "prior_value_quartile")
    return tiled.select("household_key", "campaign", "prior_value_quartile")


@query
def top_department(s):
    tx = s["transactions"]
    end = X.observation_end(tx)
    return X.top_departments(X.observed_products(tx, s["products"], end)).select(
        "household_key", "top_department", F.round(money("top_u"), 2).alias("department_spend")
    )


@query
def demographic_gaps(s):
    buyers = s["transactions"].select("household_key").distinct().join(s["households"], "household_key", "left")
    return buyers.select(
        "household_key", X.all_null_flag(buyers, X.DEMOGRAPHIC_COLUMNS).alias("missing_demographic_flag")
    )


@query
def supported_categories(s):
    return C.min_support(_categories(s), "household_count", 50).select("department", "commodity_desc", "household_count")


@query
def index_gaps(s):
    def gaps(name):
        return (F.max(name) - F.min(name) + 1 - F.count_distinct(name)).alias(f"{name}_gaps")

    return s["transactions"].select("day", "week_no").distinct().agg(gaps("day"), gaps("week_no"))


@query
def label_collisions(s):
    """Spellings that become one label once case and outer blanks are ignored."""
    labels = s["products"].filter(F.col("commodity_desc").isNotNull())
    normal = F.upper(F.trim("commodity_desc")).alias("normalized_label")
    return labels.groupBy(normal).agg(F.count_distinct("commodity_desc").alias("spellings")).filter("spellings > 1")
