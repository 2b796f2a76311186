"""Hot keys and joins that cannot be broadcast give the same results as the plain definitions."""

import random
import re

import pytest
from compare import connect, differences
from data import dicts, staged
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from basketmart import catalog
from basketmart.plans import baskets, campaigns, categories, customers, products, promotion

FOLDER = "/root/testdata/sf0.001"
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4kb",
}


@pytest.fixture()
def no_broadcast(spark):
    """Every join shuffles, every slightly larger partition is split."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name", ["mart_products", "mart_category_period", "campaign_bias_comparison", "average_ranks", "exact_grain_join"]
)
def test_queries_hold_without_broadcast_joins(spark, no_broadcast, name):
    assert differences(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) == []


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the lines belongs to one household, one product, one basket and one shelf week."""
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            keys = {"household_key": 1, "product_id": 1, "basket_id": 1, "store_id": 1, "week_no": 10, "day": 65}
        else:
            week = rng.randrange(1, 30)
            keys = {
                "household_key": rng.randrange(1, 60),
                "product_id": rng.randrange(1, 40),
                "basket_id": rng.randrange(2, 900),
                "store_id": rng.randrange(1, 5),
                "week_no": week,
                "day": week * 7 - rng.randrange(7),
            }
        rows.append({**keys, "sales_value": rng.randrange(1, 9999) / 100, "coupon_disc": rng.choice([None, -0.25])})
    return staged(
        spark,
        rows,
        product=[(p, 1, "b", "s", f"D{p % 3}", "HOT" if p % 2 else "C", "x") for p in range(1, 38)],
        causal_data=[(1, 1, 10, "1", "0")] * 50 + [(p, 1, w, "0", "A") for p in range(2, 9) for w in range(1, 30)],
        campaign_desc=[(c, f"Type{'ABC'[c % 3]}", 20 * c, 20 * c + 30) for c in range(1, 8)],
        campaign_table=[(h, c) for h in range(1, 60) for c in range(1, 8) if c == 1 or (h + c) % 4 == 0],
        coupon_redempt=[(h, 30, 5, 1) for h in range(1, 60, 2)],
    )


def test_hot_product_and_category(spark, no_broadcast, hot):
    tx, listed = hot["transactions"], hot["products"]
    plain = tx.groupBy("product_id").agg(
        F.count_distinct("basket_id").alias("b"), F.count_distinct("household_key").alias("h")
    )
    repeat = (
        tx.groupBy("product_id", "household_key")
        .agg(F.count_distinct("basket_id").alias("n"))
        .groupBy("product_id")
        .agg(F.count_if(F.col("n") > 1).alias("r"))
    )
    all_b, all_h = tx.agg(F.count_distinct("basket_id"), F.count_distinct("household_key")).first()
    want = {
        r["product_id"]: (r["b"] / all_b, r["h"] / all_h, r["r"]) for r in plain.join(repeat, "product_id").collect()
    }
    got = {
        r["product_id"]: (r["basket_penetration"], r["household_penetration"], r["repeat_household_count"])
        for r in products.mart_products(tx, listed).collect()
    }
    assert got == want
    labelled = categories.labelled_lines(tx, listed)
    plain = labelled.groupBy("department", "commodity_desc").agg(
        F.count_distinct("basket_id").alias("b"),
        F.count_distinct("household_key").alias("household_count"),
        F.round(F.sum("sales_value"), 2).alias("s"),
    )
    want = [(r["department"], r["commodity_desc"], r["household_count"], r["b"] / all_b, r["s"]) for r in
            plain.orderBy("department", "commodity_desc").collect()]
    got = [(r["department"], r["commodity_desc"], r["household_count"], r["basket_penetration"], r["category_sales"]) for r in
           categories.mart_categories(tx, listed).orderBy("department", "commodity_desc").collect()]
    assert got == want


def test_hot_shelf_week_and_basket(spark, no_broadcast, hot):
    tx = hot["transactions"]
    shut, shown = dicts(promotion.mart_promotion_performance(tx, hot["merchandising"]), "promotion_status")
    total = tx.agg(F.round(F.sum("sales_value"), 2)).first()[0]
    assert shut["transaction_lines"] + shown["transaction_lines"] == 3000
    assert round(shut["sales"] + shown["sales"], 2) == total
    biggest = baskets.mart_baskets(tx).orderBy(F.col("basket_item_line_count").desc()).first()
    assert (biggest["basket_id"], biggest["household_key"], biggest["distinct_product_count"]) == (1, 1, 1)
    assert biggest["basket_item_line_count"] == 1000


def test_hot_household_in_day_windows(spark, no_broadcast, hot):
    """The day ledger agrees with joining every line to every window."""
    tx = hot["transactions"]
    lines = tx.select(F.col("household_key").alias("hk"), "day", "basket_id", "sales_value")
    dated = hot["exposures"].join(hot["campaigns"], "campaign")
    start = F.col("start_day")
    inside = (F.col("hk") == F.col("household_key")) & F.col("day").between(start - 28, start + 27)
    before = F.col("day") < start
    plain = (
        dated.join(lines, inside, "left")
        .groupBy("household_key", "campaign")
        .agg(
            F.round(F.coalesce(F.sum(F.when(before, F.col("sales_value"))), F.lit(0.0)), 2).alias("pre"),
            F.count_distinct(F.when(before, F.col("basket_id"))).alias("pre_b"),
            F.count_distinct(F.when(~before, F.col("basket_id"))).alias("post_b"),
        )
    )
    want = {(r["household_key"], r["campaign"]): (r["pre"], r["pre_b"], r["post_b"]) for r in plain.collect()}
    behaviour = campaigns.exposure_behaviour(tx, hot["exposures"], hot["campaigns"], hot["redemptions"])
    got = {
        (r["household_key"], r["campaign"]): (round(r["pre_u"] / 10000, 2), r["pre_baskets"], r["post_baskets"])
        for r in behaviour.collect()
    }
    assert got == want
    ledger = campaigns.household_day_ledger(tx).filter("household_key = 1")
    assert ledger.count() < 300 < tx.filter("household_key = 1").count()


def test_hot_campaign_is_cut_into_quartiles(spark, no_broadcast, hot):
    frame = campaigns.campaign_bias_comparison(
        hot["transactions"], hot["exposures"], hot["campaigns"], hot["redemptions"]
    )
    sizes = frame.filter("campaign_type = 'TypeB'").groupBy("prior_value_quartile").agg(
        F.sum("household_campaign_exposures")
    )
    per_campaign = hot["exposures"].join(hot["campaigns"], "campaign").filter("description = 'TypeB'")
    counts = [r["count"] for r in per_campaign.groupBy("campaign").count().collect()]
    want = {t: sum(n // 4 + (t <= n % 4) for n in counts) for t in (1, 2, 3, 4)}
    assert {r[0]: r[1] for r in sizes.collect()} == want
    segments = customers.household_segments(baskets.mart_baskets(hot["transactions"]))
    assert segments.count() == hot["transactions"].select("household_key").distinct().count()


@pytest.fixture()
def receipts(spark, tmp_path):
    """A folder with 40 orders of one to five lines, one of them without a household."""
    orders = [(o, None if o == 7 else o % 9, f"199{5 + o % 3}-03-{o % 28 + 1:02d}") for o in range(1, 41)]
    lines = [
        (o, o * line % 13 + 1, line, o % 4, float(line), 10.0 * line + o, 0.05, "N", "O")
        for o in range(1, 41)
        for line in range(1, o % 5 + 2)
    ]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").withColumn(
        "o_orderdate", F.to_timestamp("o_orderdate")
    ).write.parquet(f"{tmp_path}/orders.parquet")
    schema = "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, "
    schema += "l_discount double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["mart_baskets", "mart_baskets_legacy", "kpi_summary"])
def test_baskets_need_no_shuffle_beyond_the_join(spark, no_broadcast, receipts, name):
    plan = queries()[name](spark, receipts)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\((.*?),? \d+\)", plan)
    basket_keys = [key for key in keys if "active_households" not in key and not re.fullmatch(r"household_key#\d+L?", key)]
    assert len(basket_keys) == 2 and all("orderkey" in key and "," not in key for key in basket_keys)


def test_stored_baskets_equal_those_of_the_stored_lines(spark, no_broadcast, receipts):
    tables = catalog.staged(spark, receipts)
    got, want = tables["stored_baskets"], baskets.mart_baskets(tables["transactions"])
    assert got.count() == 40 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


@pytest.mark.parametrize("make, period", [(categories.mart_categories, []), (categories.mart_category_period, ["quarter_like_period"])])
def test_categories_shuffle_numbers_once_per_counted_key(spark, hot, make, period):
    frame = make(hot["transactions"], hot["products"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\((.*?),? \d+\)", plan)
    assert not any("department" in key or "product_id" in key for key in keys)
    counted = [key for key in keys if "_category" in key and ("basket_id" in key or "household_key" in key)]
    assert len(counted) == 2 and all(len(key.split(",")) == 2 + len(period) for key in counted)


def test_category_numbers_tell_categories_apart(spark, no_broadcast):
    """Missing labels, labels that read UNKNOWN, missing and repeated products, missing households, baskets and weeks."""
    labels = [(1, "A", "B"), (2, "A", None), (3, None, None), (4, "UNKNOWN", "UNKNOWN"), (5, "A", "B"), (5, "C", "B"), (5, "C", "B")]
    rows = [
        {"product_id": p, "household_key": h, "basket_id": b, "week_no": w, "sales_value": 1.0}
        for p, h, b, w in [(1, 1, 1, 1), (1, 1, 2, 20), (5, 2, None, 1), (2, 1, 1, 1), (3, None, 3, 1), (4, 1, 4, 1),
                           (9, 1, 3, 1), (None, 3, 3, 1), (5, 1, 1, None)]
    ]
    s = staged(spark, rows, product=[(p, 1, "b", "s", d, c, "x") for p, d, c in labels])
    periods = categories.mart_category_period(s["transactions"], s["products"]).collect()
    got = {(r["department"], r["commodity_desc"], r["quarter_like_period"]): (r["sales"], r["households"], r["baskets"]) for r in periods}
    assert len(got) == len(periods) and got == {
        ("A", "B", 1): (2.0, 2, 1),
        ("A", "B", 2): (1.0, 1, 1),
        ("A", "B", None): (1.0, 1, 1),
        ("A", "UNKNOWN", 1): (1.0, 1, 1),
        ("C", "B", 1): (2.0, 1, 0),
        ("C", "B", None): (2.0, 1, 1),
        ("UNKNOWN", "UNKNOWN", 1): (4.0, 2, 2),
    }
    whole = categories.mart_categories(s["transactions"], s["products"]).collect()
    got = {(r["department"], r["commodity_desc"]): (r["category_sales"], r["household_count"], r["basket_penetration"]) for r in whole}
    assert got == {
        ("A", "B"): (4.0, 2, 2 / 4),
        ("A", "UNKNOWN"): (1.0, 1, 1 / 4),
        ("C", "B"): (4.0, 2, 1 / 4),
        ("UNKNOWN", "UNKNOWN"): (4.0, 2, 2 / 4),
    }
