import math
from itertools import product
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketmart.functions.pvalues import normal_two_sided, student_two_sided
from basketmart.plans import components, matrix, model
from basketmart.plans.statistics import bootstrap_interval, discount_groups, two_sample_ranks, welch_spend


def test_student_p_values_match_closed_forms():
    for t in (0.0, 0.3, 1.7, 4.0):
        assert student_two_sided(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, abs=1e-12)
        assert student_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
        assert student_two_sided(t, 1e6) == pytest.approx(student_two_sided(t, 1e6 + 1), abs=1e-9)
        assert student_two_sided(t, 1e15) == pytest.approx(2 * NormalDist().cdf(-t), abs=1e-12)
        assert student_two_sided(t, 5e7) == pytest.approx(2 * NormalDist().cdf(-t), abs=1e-6)
    assert normal_two_sided(1.959963984540054) == pytest.approx(0.05)


def test_mann_whitney_counts_pairs_with_half_for_ties(spark):
    rng = np.random.default_rng(1)
    first, second = rng.integers(0, 6, 23).tolist(), rng.integers(2, 8, 31).tolist()
    rows = [(float(v), True) for v in first] + [(float(v), False) for v in second] + [(None, True), (1.0, None)]
    frame = spark.createDataFrame(rows, "v double, g boolean")
    row = two_sample_ranks(frame, F.col("v"), F.col("g")).first()
    wins = sum((a > b) + 0.5 * (a == b) for a, b in product(first, second))
    assert (row["u_statistic"], row["first_rows"], row["second_rows"]) == (wins, 23, 31)


def test_discount_groups_respect_the_minimum(spark):
    rows = [(float(i), i / 10 if i else None, 50 if i % 2 else 49) for i in range(9)]
    frame = spark.createDataFrame(rows, "category_sales double, discount_rate double, household_count long")
    both = discount_groups(frame).first()
    assert (both["first_rows"], both["second_rows"]) == (4, 4)
    assert both["u_statistic"] == 16.0
    supported = discount_groups(frame, 50).first()
    assert supported["first_rows"] + supported["second_rows"] == 4


def test_welch_matches_the_formula(spark):
    early, late = [1.0, 2.0, 6.0, 3.0], [4.0, 9.0, 5.0, 8.0]
    rows = [(i % 2 + 1, v) for i, v in enumerate(early)] + [(i % 2 + 3, v) for i, v in enumerate(late)]
    row = welch_spend(spark.createDataFrame(rows, "period_id int, total_spend double")).first()
    a, b = np.var(early, ddof=1) / 4, np.var(late, ddof=1) / 4
    assert row["t_statistic"] == pytest.approx((np.mean(early) - np.mean(late)) / math.sqrt(a + b))
    assert row["degrees_of_freedom"] == pytest.approx((a + b) ** 2 / (a**2 / 3 + b**2 / 3))


def test_bootstrap_interval_covers_the_mean_with_the_right_width(spark):
    rng = np.random.default_rng(5)
    cents = np.round(rng.gamma(2.0, 20.0, 20_000) * 100).astype(int)
    frame = spark.createDataFrame([(i, int(c) * 100) for i, c in enumerate(cents)], "k long, u long")
    row = bootstrap_interval(frame, "k", "u", "x").first()
    again = bootstrap_interval(frame.repartition(7), "k", "u", "x").first()
    assert row == again
    mean, error = cents.mean() / 100, cents.std(ddof=1) / 100 / math.sqrt(len(cents))
    assert row["lower"] < mean < row["upper"]
    assert (row["upper"] - row["lower"]) / (2 * 1.96 * error) == pytest.approx(1.0, abs=0.15)


def cells(spark):
    rng = np.random.default_rng(2)
    dense = np.round(rng.gamma(1.0, 30.0, (60, 8)), 2) * (rng.random((60, 8)) < 0.6)
    dense[:, 7] = 12.5  # constant column
    rows = [
        (h, f"c{c}", round(float(dense[h, c]) * 10_000))
        for h in range(60)
        for c in range(8)
        if dense[h, c] or (h + c) % 5 == 0
    ]
    return dense, spark.createDataFrame(rows, "household_key long, commodity_desc string, spend_u long")


def test_matrix_profile_and_similarity_match_a_dense_matrix(spark):
    dense, frame = cells(spark)
    profile = matrix.matrix_profile(frame).first()
    assert (profile["matrix_rows"], profile["matrix_columns"]) == (60, 8)
    assert profile["sparsity"] == pytest.approx((dense == 0).mean())
    deviation = dense.std(axis=0)
    scaled = dense / np.where(deviation > 1e-9, deviation, 1.0)
    sample = scaled[:25]
    cosine = sample @ sample.T / np.outer(np.linalg.norm(sample, axis=1), np.linalg.norm(sample, axis=1))
    np.fill_diagonal(cosine, -1)
    a, b = sorted(int(i) for i in np.unravel_index(np.argmax(cosine), cosine.shape))
    best = matrix.nearest_households(frame, 25).first()
    assert (best["household_a"], best["household_b"]) == (a, b)
    assert best["cosine_similarity"] == pytest.approx(cosine[a, b])
    anchored = matrix.nearest_to_first_household(frame).first()
    lengths = np.linalg.norm(scaled, axis=1)
    every = scaled @ scaled[0] / (lengths * lengths[0])
    every[0] = -1
    assert (anchored["household_a"], anchored["household_b"]) == (0, int(np.argmax(every)))


def test_pca_shares_match_eigenvalues(spark):
    dense, frame = cells(spark)
    dense = dense[:, :7]
    frame = frame.filter("commodity_desc <> 'c7'")
    values = np.sort(np.linalg.eigvalsh(np.cov((dense / dense.std(axis=0, ddof=1)).T)))[::-1]
    got = [r["variance_share"] for r in components.pca_variance(frame).orderBy("component").collect()]
    assert got == pytest.approx((values / values.sum())[:5])


def test_quotas_round_up_and_follow_the_largest_remainder():
    assert model.test_quotas({0: 10, 1: 30}) == {0: 3, 1: 7} or model.test_quotas({0: 10, 1: 30}) == {0: 2, 1: 8}
    assert sum(model.test_quotas({0: 499, 1: 2000}).values()) == 625
    assert model.test_quotas({1: 8}) == {1: 2}


def feature_rows(spark, rows=400):
    rng = np.random.default_rng(11)
    signal = rng.normal(size=rows)
    label = (signal + rng.normal(scale=0.7, size=rows) > -0.5).astype(int)
    data = [
        (
            i,
            float(signal[i]) if i % 17 else None,
            int(rng.integers(0, 9)),
            ["x", "y", None][i % 3] if i % 50 else "only here",
            5.0,
            int(label[i]),
            0,
        )
        for i in range(rows)
    ]
    return spark.createDataFrame(
        data,
        """household_key long, score double, visits int, kind string, future_spend double,
        next_period_active_flag int, next_period_spend_decline_flag int""",
    )


def test_split_is_stratified_and_repeatable(spark):
    frame = feature_rows(spark)
    split = model.stratified_split(frame)
    assert split.count() == 400 and split.filter("is_test").count() == 100
    shares = {r[0]: r[1] for r in split.groupBy(model.TARGET).agg(F.avg(F.col("is_test").cast("int"))).collect()}
    assert all(abs(share - 0.25) < 0.02 for share in shares.values())
    again = model.stratified_split(frame.repartition(5))
    key = ["household_key", "is_test"]
    assert split.select(key).exceptAll(again.select(key)).count() == 0


def test_predictors_never_include_labels(spark):
    numeric, categorical = model.predictors(feature_rows(spark))
    assert (numeric, categorical) == (["score", "visits"], ["kind"])


def test_model_learns_on_training_rows_only(spark):
    fitted = model.fit_holdout_model(feature_rows(spark))
    assert (fitted.train_rows, fitted.test_rows) == (300, 100)
    assert 0.75 < model.holdout_auc(fitted.scored).first()["auc"] <= 1.0
    weights = dict(zip(fitted.names, fitted.coefficients))
    assert max(weights, key=lambda name: abs(weights[name])) == "numeric__score"
    assert "categorical__kind_only here" not in weights and "categorical__kind___rare__" in weights
    assert not any("__unseen__" in name for name in weights)


def test_imputation_uses_interpolated_median_and_first_mode(spark):
    frame = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (10.0, "b"), (20.0, "a"), (None, None)], "x double, c string")
    assert model.train_medians(frame, ["x"]) == {"x": 6.0}
    modes = model.train_modes(frame, ["c"])
    assert modes == {"c": "a"}
    rows = model.level_places(frame, ["c"], modes).collect()
    assert {(r.name, r.level, r.label) for r in rows} == {("c", "a", "a"), ("c", "b", model.RARE)}


@pytest.mark.parametrize("rows, columns, rank", [(80, 6, 6), (120, 60, 60), (90, 40, 3)])
def test_pca_of_wide_and_of_flat_matrices(spark, rows, columns, rank):
    rng = np.random.default_rng(rows)
    dense = np.round(np.abs(rng.normal(size=(rows, rank)) @ rng.normal(size=(rank, columns))) if rank < 6 else rng.gamma(1, 9, (rows, columns)), 4)
    dense[:, 1] = 4.0  # no variance
    cells = [(r, f"c{c}", round(dense[r, c] * 10000)) for r in range(rows) for c in range(columns) if dense[r, c]]
    frame = spark.createDataFrame(cells, "household_key int, commodity_desc string, spend_u long")
    kept = np.delete(dense, 1, axis=1)
    values = np.sort(np.linalg.eigvalsh(np.cov((kept / kept.std(axis=0)).T)))[::-1]
    got = components.pca_variance(frame).orderBy("component").collect()
    assert [r.variance_share for r in got] == pytest.approx(list((values / values.sum())[:5]), abs=1e-6)
    assert got[-1].cumulative_share == pytest.approx(sum(r.variance_share for r in got))


def test_pca_without_variance(spark):
    same = spark.createDataFrame([(r, "c", 5) for r in range(4)], "household_key int, commodity_desc string, spend_u long")
    assert components.pca_variance(same).count() == 0
    assert components.pca_variance(same.filter("household_key = 0")).count() == 0
    assert components.pca_variance(same.filter("spend_u < 0")).count() == 0


def dense_logistic(x, y, weight):
    """Newton's method on a whole matrix; the last column is the intercept."""
    w, ridge = np.zeros(x.shape[1]), np.append(np.ones(x.shape[1] - 1), 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-12), x.T @ (weight * (p - y)) + ridge * w)
    return w


@pytest.mark.parametrize("dense", [256, 0])
def test_newton_steps_agree_with_a_dense_fit(spark, monkeypatch, dense):
    monkeypatch.setattr(model, "DENSE", dense)
    monkeypatch.setattr(model, "CHUNK", 37)
    features = feature_rows(spark, 300)
    fitted = model.fit_holdout_model(features)
    split = model.stratified_split(features).toPandas()
    train = split[~split.is_test]
    kinds = train.kind.fillna("x" if (train.kind == "x").sum() >= (train.kind == "y").sum() else "y")
    kinds = kinds.where(kinds.isin(["x", "y"]), "__rare__")
    columns, names = [], []
    for name in ("score", "visits"):
        values = train[name].fillna(train[name].median()).to_numpy(float)
        columns.append((values - values.mean()) / values.std(ddof=1))
        names.append(f"numeric__{name}")
    for kind in sorted(set(kinds)):
        columns.append((kinds == kind).to_numpy(float))
        names.append(f"categorical__kind_{kind}")
    y = train[model.TARGET].to_numpy(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    want = dense_logistic(np.column_stack([*columns, np.ones(len(y))]), y, weight)
    assert fitted.names == names
    assert fitted.coefficients == pytest.approx(want[:-1], abs=1e-7)


def test_thousands_of_levels_and_unseen_ones(spark):
    rows = [(i, float(i % 7), f"level {i % 600}" if i % 5 else f"only {i}", None, int(i % 7 > 3), 0, 0.0) for i in range(14_000)]
    features = spark.createDataFrame(
        rows,
        """household_key long, score double, kind string, gap string,
        next_period_active_flag int, next_period_spend_decline_flag int, future_spend double""",
    )
    split = model.stratified_split(features)
    train = split.filter("not is_test")
    modes = model.train_modes(train, ["kind", "gap"])
    assert modes["gap"] == model.RARE
    places = model.level_places(train, ["kind", "gap"], modes)
    found = places.collect()
    assert len({r.place for r in found}) == max(r.place for r in found) + 1
    assert {r.label for r in found if r.level.startswith("only")} == {model.RARE}
    encoded = model._encoded(split, ["score"], {"score": 0.0}, modes, places)
    rare = {r.place for r in found if r.name == "kind" and r.label == model.RARE}
    unseen = encoded.join(features.filter("kind like 'only%'").select("household_key"), "household_key").filter("is_test")
    assert {r.slots[0] for r in unseen.collect()} == rare
    assert encoded.count() == 14_000
