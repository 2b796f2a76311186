import random

import pytest
from data import dicts, staged
from pyspark.sql import functions as F

from basketmart.plans import baskets, campaigns, categories, features, household_period, products, promotion
from basketmart.plans.validation import validation_checks
from basketmart.plans.warehouse import marts


def test_basket_rate_is_null_without_gross(spark):
    s = staged(
        spark,
        [
            {"basket_id": 1, "sales_value": 8.0, "retail_disc": -1.5, "coupon_disc": -0.5, "quantity": 2.0},
            {"basket_id": 1, "sales_value": 0.0, "product_id": 1, "quantity": 0.0, "day": 3},
            {"basket_id": 2, "sales_value": 0.0, "household_key": 2},
        ],
    )
    first, second = dicts(baskets.mart_baskets(s["transactions"]), "basket_id")
    assert (first["basket_spend"], first["gross_sales"], first["discount_rate"]) == (8.0, 10.0, 0.2)
    assert (first["distinct_product_count"], first["basket_item_line_count"], first["coupon_used_flag"]) == (1, 2, 1)
    assert (second["discount_rate"], second["coupon_used_flag"]) == (None, 0)
    legacy = dicts(baskets.mart_baskets(s["transactions"], legacy_rate=True), "basket_id")
    assert legacy[0]["discount_rate"] == pytest.approx(2.0 / 9.5)
    assert "gross_sales" not in legacy[0]


def test_basket_shared_by_two_households_gives_two_rows(spark):
    s = staged(spark, [{"household_key": 1}, {"household_key": 2}])
    assert baskets.mart_baskets(s["transactions"]).count() == 2


def period_mart(spark, transactions, **tables):
    s = staged(spark, transactions, **tables)
    return household_period.mart_household_period(
        baskets.mart_baskets(s["transactions"]),
        s["transactions"],
        s["products"],
        s["exposures"],
        s["campaigns"],
        s["redemptions"],
    )


def test_spine_is_complete_and_retention_needs_adjacent_periods(spark):
    frame = period_mart(
        spark,
        [
            {"household_key": 1, "basket_id": 1, "week_no": 1, "day": 1},
            {"household_key": 1, "basket_id": 2, "week_no": 9, "day": 60},
            {"household_key": 2, "basket_id": 3, "week_no": 1, "day": 5},
            {"household_key": 2, "basket_id": 4, "week_no": 5, "day": 30, "sales_value": 3.0},
        ],
    )
    rows = dicts(frame, "household_key", "period_id")
    assert [(r["household_key"], r["period_id"], r["active_flag"], r["retention_repeat_flag"]) for r in rows] == [
        (1, 1, 1, 0),
        (1, 2, 0, 0),
        (1, 3, 1, 0),
        (2, 1, 1, 0),
        (2, 2, 1, 1),
        (2, 3, 0, 0),
    ]
    assert rows[0]["spend_change"] is None and rows[1]["spend_change"] == -1.0
    assert rows[1]["average_basket_value"] is None and rows[1]["discount_rate"] is None
    assert [r["incomplete_period_flag"] for r in rows] == [0, 0, 1, 0, 0, 1]
    assert [r["period_end"] for r in rows[:3]] == [28, 56, 60]
    summary = dicts(household_period.customer_period_summary(frame), "period_id")
    assert [r["retained_households"] for r in summary] == [0, 1, 0]
    assert [r["retention_rate"] for r in summary] == [None, 0.5, 0.0]
    matrix = dicts(household_period.customer_retention_matrix(frame), "cohort_period", "period_id")
    assert [(r["active_households"], r["cohort_households"]) for r in matrix] == [(2, 2), (1, 2), (1, 2)]


def test_no_period_is_cut_short_when_the_last_day_ends_one(spark):
    frame = period_mart(spark, [{"week_no": 4, "day": 28}])
    assert frame.first()["incomplete_period_flag"] == 0


def test_events_outside_the_spine_are_dropped_and_counted(spark):
    tables = {
        "campaign_desc": [(1, "TypeA", 1, 20), (2, "TypeA", 200, 220)],
        "campaign_table": [(1, 1), (1, 2), (99, 1)],
        "coupon_redempt": [(1, 3, 10, 1), (99, 3, 10, 1)],
    }
    frame = period_mart(spark, [{"week_no": 1, "day": 3}], **tables)
    row = frame.collect()
    assert len(row) == 1
    assert (row[0]["campaign_exposure_count"], row[0]["coupon_redemption_count"]) == (1, 1)
    s = staged(spark, [{"week_no": 1, "day": 3}], **tables)
    dropped = household_period.dropped_events(frame, s["exposures"], s["campaigns"], s["redemptions"])
    assert {r["event"]: r["dropped_events"] for r in dropped.collect()} == {
        "campaign_exposures": 2,
        "coupon_redemptions": 1,
    }


def test_product_growth_null_rules_and_repeat_households(spark):
    s = staged(
        spark,
        [
            {"product_id": 1, "week_no": 1, "basket_id": 1, "sales_value": 4.0},
            {"product_id": 1, "week_no": 20, "basket_id": 2, "sales_value": 6.0},
            {"product_id": 2, "week_no": 1, "basket_id": 1, "sales_value": 4.0},
            {"product_id": 3, "week_no": 20, "basket_id": 2, "household_key": 2, "sales_value": 5.0},
            {"product_id": 3, "week_no": 20, "basket_id": 2, "household_key": 2, "sales_value": 5.0},
        ],
        product=[(1, 7, "National", "1 OZ", "D", "C", "S"), (1, 7, None, "1 OZ", "D", "C", "S")],
    )
    rows = {r["product_id"]: r for r in dicts(products.mart_products(s["transactions"], s["products"]))}
    assert (rows[1]["sales_growth"], rows[1]["sales_growth_rate"], rows[1]["repeat_household_count"]) == (2.0, 0.5, 1)
    assert rows[1]["brand"] == "National" and rows[1]["product_sales"] == 20.0  # listed twice, so counted twice
    assert (rows[2]["sales_growth"], rows[2]["sales_growth_rate"]) == (-4.0, None)
    assert (rows[3]["sales_growth"], rows[3]["sales_growth_rate"], rows[3]["repeat_household_count"]) == (10.0, None, 0)
    assert rows[3]["department"] is None and rows[3]["household_penetration"] == 0.5


def test_unknown_category_and_shared_labels(spark):
    s = staged(
        spark,
        [
            {"product_id": 1, "household_key": 1, "basket_id": 1},
            {"product_id": 2, "household_key": 1, "basket_id": 1},
            {"product_id": 3, "household_key": 2, "basket_id": 2, "week_no": 60},
            {"product_id": 4, "household_key": 2, "basket_id": 2},
        ],
        product=[(p, 1, "b", "s", "D", "C", "x") for p in (1, 2, 3)],
    )
    known, unknown = dicts(categories.mart_categories(s["transactions"], s["products"]), "department")
    assert (known["household_count"], known["basket_penetration"], known["units"]) == (2, 1.0, 3.0)
    assert (known["first_year_sales"], known["second_year_sales"], known["sales_growth_rate"]) == (2.0, 1.0, -0.5)
    assert (unknown["department"], unknown["commodity_desc"], unknown["household_count"]) == ("UNKNOWN", "UNKNOWN", 1)


def test_duplicate_merchandising_neither_fans_out_nor_loses_a_flag(spark):
    s = staged(
        spark,
        [{"product_id": 1, "sales_value": 2.0}, {"product_id": 1, "sales_value": 3.0}, {"product_id": 2}],
        causal_data=[(1, 1, 1, "0", "0"), (1, 1, 1, "1", None), (1, 1, 1, None, "0"), (2, 1, 1, "0", None)],
    )
    shut, shown = dicts(promotion.mart_promotion_performance(s["transactions"], s["merchandising"]), "promotion_status")
    assert (shown["sales"], shown["transaction_lines"], shown["product_store_weeks"]) == (5.0, 2, 1)
    assert (shut["promotion_status"], shut["sales"]) == ("not_promoted", 1.0)


def test_only_redemptions_of_exposed_households_count(spark):
    s = staged(
        spark,
        [{}],
        campaign_desc=[(1, "TypeA", 1, 9), (2, "TypeB", 1, 9)],
        campaign_table=[(1, 1), (2, 1)],
        coupon_redempt=[(1, 2, 5, 1), (1, 3, 5, 1), (7, 3, 5, 1), (1, 3, 6, 2)],
    )
    one, two = dicts(campaigns.mart_campaigns(s["campaigns"], s["exposures"], s["redemptions"]), "campaign")
    assert (one["exposed_households"], one["redeeming_households"], one["redemption_count"]) == (2, 1, 2)
    assert one["household_redemption_rate"] == 0.5
    assert (two["exposed_households"], two["household_redemption_rate"]) == (0, None)


def test_interval_bounds_and_multi_day_baskets(spark):
    start = 100
    days = [start - 29, start - 28, start - 1, start, start + 27, start + 28]
    rows = [{"basket_id": i, "day": d, "sales_value": 10.0**i} for i, d in enumerate(days)]
    # basket 50 is seen on both sides of the start and twice after it
    rows += [{"basket_id": 50, "day": d, "sales_value": 0.0} for d in (start - 2, start + 1, start + 2)]
    s = staged(spark, rows, campaign_desc=[(1, "TypeA", start, 130)], campaign_table=[(1, 1), (2, 1)])
    behaviour = campaigns.exposure_behaviour(s["transactions"], s["exposures"], s["campaigns"], s["redemptions"])
    seen, unseen = dicts(behaviour, "household_key")
    assert (seen["pre_u"], seen["post_u"]) == (110 * 10_000, 11_000 * 10_000)
    assert (seen["pre_baskets"], seen["post_baskets"]) == (3, 3)
    assert (unseen["pre_u"], unseen["post_baskets"]) == (0, 0)


def test_top_department_ties_go_to_the_first_name(spark):
    s = staged(
        spark,
        [{"product_id": 1, "week_no": 1}, {"product_id": 2, "week_no": 1}, {"product_id": 3, "week_no": 20}],
        product=[(1, 1, "b", "s", "Z", "C", "x"), (2, 1, "b", "s", "A", "C", "x"), (3, 1, "b", "s", "A", "C", "x")],
        campaign_desc=[(1, "TypeA", 49, 60), (2, "TypeA", 50, 60)],
        campaign_table=[(1, 1), (1, 2)],
    )
    end = features.observation_end(s["transactions"])
    best = features.top_departments(features.observed_products(s["transactions"], s["products"], end)).first()
    assert (best["top_department"], best["top_u"]) == ("A", 10_000)
    row = features.mart_customer_features(
        s["transactions"], s["products"], s["exposures"], s["campaigns"], s["households"]
    ).first()
    assert (row["top_department_share"], row["future_spend"], row["next_period_active_flag"]) == (0.5, 1.0, 1)
    assert (row["recency_weeks"], row["campaign_exposure_count"], row["missing_demographic_flag"]) == (6, 1, 1)
    assert (row["product_diversity"], row["category_diversity"]) == (2, 1)


def test_all_null_flag_without_any_of_the_columns(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "k int, a string")
    assert [r[0] for r in frame.select(features.all_null_flag(frame, ["a", "b"])).collect()] == [1, 0]
    assert [r[0] for r in frame.select(features.all_null_flag(frame, ["b"])).collect()] == [1, 1]


def test_empty_merchandising_leaves_one_status(spark):
    s = staged(spark, [{}])
    assert [r["promotion_status"] for r in promotion.mart_promotion_performance(s["transactions"], s["merchandising"]).collect()] == [
        "not_promoted"
    ]


def test_validation_finds_planted_faults(spark):
    s = staged(
        spark,
        [
            {"basket_id": 1, "sales_value": -1.0, "trans_time": "9999"},
            {"basket_id": 2, "quantity": 500.0, "day": 3, "coupon_disc": None},
            {"basket_id": 2, "quantity": 500.0, "day": 3, "coupon_disc": None},
            {"basket_id": 3, "household_key": 2, "product_id": 9, "retail_disc": -2.0},
        ],
        product=[(1, 1, "b", "s", "D", "Milk", "x"), (2, 1, "b", "s", "D", " milk", "x"), (3, 1, "b", "s", "D", " ", "x")],
        coupon=[(10, 1, 1), (10, 1, 1)],
        coupon_redempt=[(1, 1, 11, 4)],
        campaign_table=[(1, 4)],
    )
    values = {r["check_name"]: r["check_value"] for r in validation_checks(s, marts(s)).collect()}
    assert len(values) == 55
    expected = {
        "negative_sales_rows": "1",
        "invalid_trans_time_rows": "1",
        "suspicious_quantity_rows_over_100": "2",
        "duplicate_transaction_rows": "1",
        "transactions_missing_product_metadata": "1",
        "discount_larger_than_net_sales_rows": "1",
        "coupon_bridge_duplicate_rows": "1",
        "redemptions_missing_campaign": "1",
        "redemptions_missing_coupon_context": "1",
        "campaign_exposures_missing_description": "1",
        "null_or_blank_category_labels": "1",
        "normalized_category_label_collisions": "1",
        "day_index_gap_count": "1",
        "demographic_uncovered_households": "2",
        "basket_fanout_ok": "true",
        "promotion_join_fanout_ok": "true",
    }
    assert {name: values[name] for name in expected} == expected


def test_distinct_tuples_count_nulls(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert frame.agg(F.count_distinct(F.struct("a", "b"))).first()[0] == 2


def test_window_totals_agree_with_adding_up_the_days(spark):
    rng = random.Random(8)
    lines = [
        {"basket_id": rng.randint(1, 60), "day": rng.choice([None, *range(40, 160)]), "sales_value": float(rng.randint(0, 9))}
        for _ in range(900)
    ]
    # a basket belongs to one household; many are seen on several days
    for line in lines:
        line["household_key"] = line["basket_id"] % 4 + 1
    descriptions = [(1, "TypeA", 90, 100), (2, "TypeB", 70, 60), (3, "TypeB", 100, None), (4, "TypeC", None, 9), (5, "TypeA", 30, 35)]
    table = [(h, c) for h in (1, 2, 3, 9) for c in range(1, 6)] + [(1, 1)]
    s = staged(spark, lines, campaign_desc=descriptions, campaign_table=table)
    held = [(l["household_key"], l["basket_id"], l["day"], l["sales_value"]) for l in lines if l["day"] is not None]

    def window(household, first, last):
        inside = [(b, v) for h, b, d, v in held if h == household and first <= d <= last]
        return round(sum(v for _, v in inside) * 10_000), len({b for b, _ in inside})

    got = campaigns.exposure_behaviour(s["transactions"], s["exposures"], s["campaigns"], s["redemptions"]).collect()
    assert len(got) == 20
    for r in got:
        start, copies = r["start_day"], 2 if (r["household_key"], r["campaign"]) == (1, 1) else 1
        (pre, pre_b), (post, post_b) = ((0, 0), (0, 0)) if start is None else (
            window(r["household_key"], start - 28, start - 1), window(r["household_key"], start, start + 27)
        )
        assert (r["pre_u"], r["post_u"]) == (pre * copies, post * copies)
        assert (r["pre_baskets"], r["post_baskets"]) == (pre_b, post_b)
    wanted = {}
    for household, campaign in table:
        _, kind, start, end = descriptions[campaign - 1]
        sums = wanted.setdefault(kind, {}).setdefault(household, [0, 0])
        if start is not None:
            sums[0] += window(household, start - 28, start - 1)[0]
            sums[1] += window(household, start, end + 28)[0] if end is not None else 0
    for r in campaigns.campaign_prepost(s["transactions"], s["exposures"], s["campaigns"]).collect():
        sums = wanted[r["campaign_type"]].values()
        assert r["households"] == len(sums)
        assert r["avg_pre_spend"] == pytest.approx(sum(a for a, _ in sums) / len(sums) / 10_000)
        assert r["avg_post_spend"] == pytest.approx(sum(b for _, b in sums) / len(sums) / 10_000)


def test_products_and_categories_of_a_period_are_counted_without_copying_rows(spark):
    """A product listed twice counts once, its two categories both; a NULL product counts as an unknown category only."""
    from basketmart.plans.household_period import _product_part

    s = staged(
        spark,
        [
            {"product_id": 1},
            {"product_id": 1, "basket_id": 2},
            {"product_id": 2},
            {"product_id": 9},
            {"product_id": None},
            {"household_key": 2, "product_id": None},
        ],
        product=[
            (1, 1, "b", "s", "D", "C", "x"),
            (1, 1, "b", "s", "D", "E", "x"),
            (2, 1, "b", "s", "D", "C", "x"),
            (2, 1, "b", "s", "D", "C", "y"),
        ],
    )
    part = _product_part(s["transactions"], s["products"])
    assert [tuple(r) for r in part.orderBy("household_key").collect()] == [(1, 1, 3, 3), (2, 1, 0, 1)]
    assert "Expand" not in part._jdf.queryExecution().optimizedPlan().toString()


def test_sizes_of_tasks_are_lowered_but_never_raised(spark):
    from basketmart.session import MOST_BYTES, tune

    for key, most in MOST_BYTES.items():
        before = spark.conf.get(key)
        for given, want in (("64MB", str(most)), ("5kb", "5kb")):
            spark.conf.set(key, given)
            assert tune(spark).conf.get(key) == want
        spark.conf.set(key, before)


def test_cells_of_a_household_lie_together(spark, many_slices):
    from pyspark.sql import functions as F

    from basketmart.plans.matrix import scaled_cells
    from basketmart.session import stored

    made = spark.range(2000).selectExpr("id % 100 as household_key", "concat('C', id div 100) as commodity_desc", "id * 100 as spend_u")
    cells = stored(scaled_cells(made))
    placed = cells.select("household_key", F.input_file_name().alias("file")).distinct()
    assert placed.select("file").distinct().count() > 1
    assert placed.count() == 100
