"""Leakage-safe baseline: predict next-period activity from observed features.

Everything that is learned (medians, modes, frequent levels, scaling, coefficients) is learned on the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from basketmart.operators.ordering import exact_quantiles, row_numbers
from basketmart.plans.features import HOUSEHOLD, LABELS
from basketmart.plans.statistics import two_sample_ranks
from basketmart.session import stored

TARGET = "next_period_active_flag"
TEST_SHARE = 0.25
SEED = 42
RARE_BELOW = 20
RARE = "__rare__"
DENSE = 256  # coefficients up to which the driver solves with the whole Hessian
CHUNK = 4_096  # rows a task encodes at once
MOST_STEPS = 60


def predictors(features: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and categorical predictor names; labels and the key never qualify."""
    usable = [f for f in features.schema.fields if f.name not in {*LABELS, HOUSEHOLD}]
    numeric = [f.name for f in usable if isinstance(f.dataType, NumericType)]
    return numeric, [f.name for f in usable if f.name not in numeric]


def test_quotas(sizes: dict[int, int], share: float = TEST_SHARE) -> dict[int, int]:
    """Holdout rows per label: the share of all rows rounded up, dealt out by largest remainder."""
    wanted = ceil(share * sum(sizes.values()))
    quotas = {label: int(share * size) for label, size in sizes.items()}
    by_remainder = sorted(sizes, key=lambda label: (quotas[label] - share * sizes[label], label))
    for label in by_remainder[: wanted - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def stratified_split(features: DataFrame, label: str = TARGET) -> DataFrame:
    """Adds ``is_test``: within each label the rows are put in a seeded hash order and the first quarter is held out."""
    sizes = {row[label]: row["count"] for row in features.groupBy(label).count().collect()}
    quota = F.lit(0)
    for value, rows in test_quotas(sizes).items():
        quota = F.when(F.col(label) == value, rows).otherwise(quota)
    shuffled = features.withColumn("_order", F.md5(F.concat_ws("-", F.lit(str(SEED)), F.col(HOUSEHOLD).cast("string"))))
    numbered = row_numbers(shuffled, ["_order", HOUSEHOLD], [label], "_rn")
    return numbered.withColumn("is_test", F.col("_rn") <= quota).drop("_order", "_rn", "_rn_of")


def train_medians(train: DataFrame, numeric: list[str]) -> dict[str, float]:
    """Interpolated training median of each numeric predictor (one value per column)."""
    found = exact_quantiles(train, {name: F.col(name) for name in numeric}, [0.5]).collect()
    return {row["series"]: row["quantile"] for row in found}


def _levels(train: DataFrame, categorical: list[str]) -> DataFrame:
    """``name, level, n``: how many training rows hold a level, missing ones left out."""
    pairs = ", ".join(f"'{name}', cast(`{name}` as string)" for name in categorical)
    melted = train.selectExpr(f"stack({len(categorical)}, {pairs}) as (name, level)")
    return melted.filter("level is not null").groupBy("name", "level").agg(F.count("*").alias("n"))


def train_modes(train: DataFrame, categorical: list[str]) -> dict[str, str]:
    """The most frequent training level of each categorical predictor, the first by name of equals; RARE without any."""
    if not categorical:
        return {}
    best = F.min(F.struct((-F.col("n")).alias("minus"), "level"))
    found = _levels(train, categorical).groupBy("name").agg(best.alias("best")).collect()  # one row for each predictor
    return {name: RARE for name in categorical} | {row["name"]: row["best"]["level"] for row in found}


def level_places(train: DataFrame, categorical: list[str], modes: dict[str, str]) -> DataFrame:
    """``name, level, label, place``: the label each training level takes, its own or RARE, and that label's place among
    the indicator columns, by predictor and label. A table, however many levels there are."""
    order = F.create_map(*[F.lit(x) for pair in enumerate(categorical) for x in reversed(pair)])
    mode = F.create_map(*[F.lit(x) for pair in modes.items() for x in pair])
    own = (F.col("n") >= RARE_BELOW) | (F.col("level") == mode[F.col("name")])
    rows = _levels(train, categorical).withColumn("label", F.when(own, F.col("level")).otherwise(RARE))
    # a predictor without any training level still fills its missing values
    empty = [(name, RARE, 0, RARE) for name in categorical if modes[name] == RARE]
    if empty:
        rows = rows.unionByName(train.sparkSession.createDataFrame(empty, "name string, level string, n long, label string"))
    rows = stored(rows.withColumn("at", order[F.col("name")]))
    labels = row_numbers(rows.select("name", "at", "label").distinct(), ["at", "label"], name="place")
    labels = labels.select("name", "label", (F.col("place") - 1).cast("int").alias("place"))
    return stored(rows.join(labels, ["name", "label"]).select("name", "level", "label", "place"))


@dataclass
class HoldoutModel:
    """Fitted model with its scored holdout rows."""

    names: list[str]
    coefficients: list[float]
    scored: DataFrame
    train_rows: int
    test_rows: int


def _encoded(
    split: DataFrame, numeric: list[str], medians: dict[str, float], modes: dict[str, str], places: DataFrame | None
) -> DataFrame:
    """``household_key, label, is_test, x`` (numeric values) and ``slots`` (an indicator's place for each predictor).

    Missing becomes median or mode; a level that is not in training takes its predictor's RARE, or no place without one.
    """
    rows = split
    rare = {}
    if places is not None:
        found = places.filter(F.col("label") == RARE).select("name", "place").distinct().collect()  # one a predictor at most
        rare = {row["name"]: row["place"] for row in found}
    for at, (name, mode) in enumerate(modes.items()):
        own = places.filter(F.col("name") == name).select(F.col("level").alias(f"_level{at}"), F.col("place").alias(f"_slot{at}"))
        level = F.coalesce(F.col(name).cast("string"), F.lit(mode))
        rows = rows.join(own, level == F.col(f"_level{at}"), "left")
    slots = [F.coalesce(f"_slot{at}", F.lit(rare.get(name, -1))) for at, name in enumerate(modes)]
    return rows.select(
        HOUSEHOLD,
        F.col(TARGET).cast("double").alias("label"),
        "is_test",
        F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(medians.get(n, 0.0))) for n in numeric]).cast("array<double>").alias("x"),
        F.array(*slots).cast("array<int>").alias("slots"),
    )


@dataclass(frozen=True)
class _Design:
    """How a row of a batch becomes coefficients' factors: scaled numbers, indicators, one for the intercept."""

    mean: np.ndarray
    scale: np.ndarray  # zero for a constant column
    indicators: int

    @property
    def width(self) -> int:
        return len(self.mean) + self.indicators + 1

    def parts(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        n = batch.num_rows
        x = batch.column("x").flatten().to_numpy().reshape(n, len(self.mean))
        slots = batch.column("slots").flatten().to_numpy().reshape(n, -1)
        return (x - self.mean) * self.scale, slots

    def times(self, x: np.ndarray, slots: np.ndarray, w: np.ndarray) -> np.ndarray:
        k = len(self.mean)
        own = np.append(w[k:-1], 0.0)  # place -1 is none
        return x @ w[:k] + own[slots].sum(axis=1) + w[-1]

    def transposed(self, x: np.ndarray, slots: np.ndarray, r: np.ndarray) -> np.ndarray:
        k = len(self.mean)
        out = np.zeros(self.width)
        out[:k] = r @ x
        for column in slots.T:
            held = column >= 0
            out[k:-1] += np.bincount(column[held], r[held], minlength=self.indicators)
        out[-1] = r.sum()
        return out

    def dense(self, x: np.ndarray, slots: np.ndarray) -> np.ndarray:
        k = len(self.mean)
        out = np.zeros((len(x), self.width + 1))  # the last column takes place -1
        out[:, :k], out[:, -2] = x, 1.0
        for column in slots.T:
            out[np.arange(len(x)), np.where(column >= 0, k + column, -1)] = 1.0
        return out[:, :-1]


def _sums(rows: DataFrame, design: _Design, w: np.ndarray, weights: dict[float, float], along: np.ndarray | None) -> np.ndarray:
    """One pass over the rows: loss, gradient, then the Hessian row by row, or its product with ``along`` if given."""
    p = design.width

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + p + (p * p if along is None else p))
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                x, slots = design.parts(batch)
                y = batch.column("label").to_numpy()
                weight = np.array([weights[v] for v in y])
                margin = design.times(x, slots, w)
                total[0] += (weight * (np.logaddexp(0.0, margin) - y * margin)).sum()
                share = 0.5 * (1.0 + np.tanh(0.5 * margin))
                total[1 : 1 + p] += design.transposed(x, slots, weight * (share - y))
                bend = weight * share * (1.0 - share)
                if along is None:
                    d = design.dense(x, slots)
                    total[1 + p :] += (d.T @ (bend[:, None] * d)).ravel()
                else:
                    total[1 + p :] += design.transposed(x, slots, bend * design.times(x, slots, along))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "value"])

    parts = rows.select("x", "slots", "label").mapInArrow(partial, "at long, value double")
    out = np.zeros(1 + p + (p * p if along is None else p))
    # as many rows as the driver's own vector or matrix has entries
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[row.at] = row.value
    return out


def _newton_step(rows: DataFrame, design: _Design, w: np.ndarray, weights: dict[float, float], ridge: np.ndarray) -> tuple:
    """Objective, gradient and Newton step at ``w``.

    Up to DENSE coefficients the Hessian is one aggregation; beyond that conjugate gradients need only its products with
    vectors, a pass each, so that the driver holds no more than a few vectors of coefficients.
    """
    p = design.width
    if p <= DENSE:
        sums = _sums(rows, design, w, weights, None)
        gradient = sums[1 : 1 + p] + ridge * w
        hessian = sums[1 + p :].reshape(p, p) + np.diag(ridge + 1e-12)
        return sums[0] + 0.5 * (ridge * w * w).sum(), gradient, np.linalg.solve(hessian, gradient)
    sums = _sums(rows, design, w, weights, np.zeros(p))
    gradient = sums[1 : 1 + p] + ridge * w
    step, left = np.zeros(p), gradient.copy()
    way, size = left.copy(), left @ left
    for _ in range(p):
        if size <= 1e-20 * max(1.0, gradient @ gradient):
            break
        bent = _sums(rows, design, w, weights, way)[1 + p :] + ridge * way
        along = size / (way @ bent)
        step, left = step + along * way, left - along * bent
        size, before = left @ left, size
        way = left + (size / before) * way
    return sums[0] + 0.5 * (ridge * w * w).sum(), gradient, step


def fit_logistic(rows: DataFrame, design: _Design, weights: dict[float, float]) -> np.ndarray:
    """Coefficients (the intercept last) with the least weighted loss plus half their squares, the intercept's left out.

    Newton steps, halved while they don't lower the objective; the rows are stored and read once a step.
    """
    ridge = np.ones(design.width)
    ridge[-1] = 0.0
    w, best, length = np.zeros(design.width), np.inf, 1.0
    base, step = w, np.zeros(design.width)
    for _ in range(MOST_STEPS):
        objective, gradient, found = _newton_step(rows, design, w, weights, ridge)
        if objective > best + 1e-9 * abs(best):
            length /= 2
            w = base - length * step
            continue
        base, best, step, length = w, objective, found, 1.0
        if np.abs(step).max() < 1e-10:
            break
        w = base - step
    return base


def fit_holdout_model(features: DataFrame) -> HoldoutModel:
    """Split, prepare, fit a class-balanced L2 logistic regression and score the holdout."""
    split = stored(stratified_split(stored(features)))
    train = split.filter(~F.col("is_test"))
    numeric, categorical = predictors(features)
    medians = train_medians(train, numeric)
    modes = train_modes(train, categorical)
    places = level_places(train, categorical, modes) if categorical else None
    encoded = stored(_encoded(split, numeric, medians, modes, places))
    training = encoded.filter(~F.col("is_test"))
    spread = [(F.avg(F.col("x")[i]), F.stddev_samp(F.col("x")[i])) for i in range(len(numeric))]
    moments = training.agg(F.count("*"), *[c for pair in spread for c in pair]).first()
    total, mean = moments[0], np.array(moments[1::2], float)
    deviation = np.array([d or 0.0 for d in moments[2::2]], float)
    scale = np.where(deviation > 0, 1.0 / np.where(deviation > 0, deviation, 1.0), 0.0)
    labels = []
    if places is not None:
        # the names of the coefficients, one for each
        labels = places.select("place", "name", "label").distinct().orderBy("place").collect()
    design = _Design(mean, scale, len(labels))
    sizes = {float(row["label"]): row["count"] for row in training.groupBy("label").count().collect()}
    weights = {value: total / (len(sizes) * count) for value, count in sizes.items()}
    w = fit_logistic(training, design, weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            share = 0.5 * (1.0 + np.tanh(0.5 * design.times(*design.parts(batch), w)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(HOUSEHOLD), batch.column("label"), pa.array(share)], [HOUSEHOLD, "label", "score"]
            )

    key = dict(encoded.dtypes)[HOUSEHOLD]
    scored = stored(encoded.filter("is_test").mapInArrow(score, f"{HOUSEHOLD} {key}, label double, score double"))
    names = [f"numeric__{name}" for name in numeric] + [f"categorical__{row['name']}_{row['label']}" for row in labels]
    return HoldoutModel(names, [float(x) for x in w[:-1]], scored, total, scored.count())


def holdout_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve from the tied ranks of the scores, one row."""
    ranks = two_sample_ranks(scored, F.col("score"), F.col("label") == 1.0)
    return ranks.select((F.col("u_statistic") / (F.col("first_rows") * F.col("second_rows"))).alias("auc"))


def model_split(features: DataFrame) -> DataFrame:
    """``household_key`` and whether it is held out."""
    return stratified_split(features).select(HOUSEHOLD, "is_test")


def model_medians(features: DataFrame) -> DataFrame:
    """``predictor`` and ``median`` of its training rows."""
    train = stored(stratified_split(stored(features))).filter(~F.col("is_test"))
    numeric, _ = predictors(features)
    found = exact_quantiles(train, {name: F.col(name) for name in numeric}, [0.5])
    return found.select(F.col("series").alias("predictor"), F.col("quantile").alias("median"))


def model_levels(features: DataFrame) -> DataFrame:
    """``predictor, level, label, place``: the indicator each training level belongs to."""
    train = stored(stratified_split(stored(features))).filter(~F.col("is_test"))
    _, categorical = predictors(features)
    places = level_places(train, categorical, train_modes(train, categorical))
    return places.withColumnRenamed("name", "predictor")


def model_holdout(features: DataFrame) -> DataFrame:
    """Holdout AUC with the sizes of both samples and of the encoded predictor set."""
    model = fit_holdout_model(features)
    return holdout_auc(model.scored).select(
        F.round("auc", 3).alias("model_auc"),
        F.lit(model.train_rows).cast("long").alias("train_rows"),
        F.lit(model.test_rows).cast("long").alias("test_rows"),
        F.lit(len(model.names)).alias("feature_count"),
    )


def model_coefficients(features: DataFrame, count: int = 10) -> DataFrame:
    """The largest coefficients by magnitude."""
    model = fit_holdout_model(features)
    table = features.sparkSession.createDataFrame(
        list(zip(model.names, model.coefficients)), "feature string, coefficient double"
    )
    return table.orderBy(F.abs("coefficient").desc(), "feature").limit(count)
