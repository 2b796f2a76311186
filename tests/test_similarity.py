"""Nearest pair over all households: against a dense matrix, with planted pairs, ties, twins and crowded commodities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketmart.plans import similarity as S
from basketmart.plans.matrix import nearest_households


def _frame(spark, matrix):
    rows = [(h + 1, f"c{c:03d}", int(round(v * 10000))) for h, row in enumerate(matrix) for c, v in enumerate(row) if v]
    return spark.createDataFrame(rows, "household_key int, commodity_desc string, spend_u long")


def _dense(matrix):
    """All cosines of the scaled matrix; keys start at 1."""
    spread = matrix.std(axis=0)
    scaled = matrix / np.where(spread > 0, spread, 1)
    norms = np.linalg.norm(scaled, axis=1)
    unit = scaled / np.where(norms > 0, norms, 1)[:, None]
    out = np.round(unit @ unit.T, 9)
    out[norms == 0] = -2
    out[:, norms == 0] = -2
    return np.triu(out + 3, 1) - 3


def _best(matrix):
    cosine = _dense(matrix)
    a, b = np.unravel_index(cosine.argmax(), cosine.shape)
    return (int(a) + 1, int(b) + 1, float(cosine[a, b]))


def _spread(seed, households, commodities, share):
    rng = np.random.default_rng(seed)
    filled = rng.random((households, commodities)) < share
    return np.round(np.where(filled, rng.lognormal(2, 1, filled.shape), 0), 2)


def _found(frame):
    row = S.nearest_households_all(frame).first()
    return row.household_a, row.household_b, pytest.approx(row.cosine_similarity, abs=2e-9)


@pytest.mark.parametrize("seed, households, commodities, share", [(1, 300, 40, 0.4), (2, 400, 200, 0.05), (3, 200, 8, 0.9)])
def test_equals_the_dense_matrix(spark, seed, households, commodities, share):
    matrix = _spread(seed, households, commodities, share)
    assert _found(_frame(spark, matrix)) == _best(matrix)


def test_pair_beyond_the_published_sample_is_found(spark):
    matrix = _spread(4, 500, 60, 0.3)
    matrix[499] = np.round(matrix[377] * 1.5, 2)
    matrix[499, 5] += 0.01
    frame = _frame(spark, matrix)
    assert _found(frame)[:2] == (378, 500)
    assert nearest_households(frame).first()[:2] != (378, 500)


def test_twins_ties_and_negative_spend(spark):
    matrix = _spread(5, 60, 12, 0.5)
    matrix[:, 3] -= np.where(matrix[:, 3] > 0, 20, 0)  # returns
    matrix[[10, 30, 50]] = 0
    matrix[[10, 30, 50], 2] = [3, 7, 11]  # one commodity each: the same direction
    matrix[[5, 45]] = 0  # no direction
    got = _found(_frame(spark, np.where(matrix == 0, 0, matrix)))
    assert got[:2] == (11, 31) and got[2] == 1.0
    assert got == _best(matrix)


def test_no_pair_that_reaches_the_bound_is_pruned(spark):
    matrix = _spread(6, 250, 30, 0.3)
    cosine = _dense(matrix)
    units = S.unit_vectors(_frame(spark, matrix)).cache()
    for bound in (0.5, 0.7, 0.85):
        want = {(a + 1, b + 1) for a, b in np.argwhere(cosine >= bound)}
        got = {tuple(r) for r in S.candidates(units, bound).collect()}
        assert want <= got and len(got) < 250 * 249 / 2


def test_lower_bound_is_a_real_cosine(spark):
    matrix = _spread(7, 250, 30, 0.3)
    units = S.unit_vectors(_frame(spark, matrix)).cache()
    bound = S._lower_bound(units)
    cosine = _dense(matrix)
    assert 0 < bound <= cosine.max() + 1e-9 and np.abs(cosine - bound).min() < 1e-8


def test_no_pair_without_two_households(spark):
    frame = _frame(spark, np.array([[1.0, 2.0]]))
    assert S.nearest_households_all(frame).count() == 0
    assert S.nearest_households_all(frame.filter(F.lit(False))).count() == 0
