"""Boosted trees against a plain numpy learner."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import boosting as B
from quarry.operators import scoring as SC


def brute(x, y, params, names):
    """Trees by trying every cut at every node, with the same fixed-point gradients."""
    n = len(y)
    scale = 2.0 ** (B.GRADIENT_BITS - math.frexp(np.abs(y).max())[1])
    cuts = []
    for c in x.T:
        v = np.sort(c[~np.isnan(c)])
        cuts.append(sorted({v[-(-j * len(v) // params.bins) - 1] for j in range(1, params.bins)}) if len(v) else [])
    pred = np.full(n, sum(math.floor(v * scale + 0.5) for v in y) / scale / n)
    trees = []
    for t in range(params.rounds):
        q = [math.floor((p - v) * scale + 0.5) for p, v in zip(pred, y)]
        s = lambda g, h: max(abs(g / scale) - params.l1, 0.0) ** 2 / (h + params.l2)
        splits, value = {}, np.zeros(n)

        def grow(node, rows, depth):
            g, h = sum(q[i] for i in rows), len(rows)
            best = None
            for f in params.columns_of(t, names) if depth < params.max_depth else ():
                v = x[rows, f]
                for b, cut in [*enumerate(cuts[f]), (len(cuts[f]), math.inf)]:
                    for missing_left in (True, False):
                        left = [i for i, z in zip(rows, v) if (missing_left if np.isnan(z) else z <= cut)]
                        gl, hl = sum(q[i] for i in left), len(left)
                        if min(hl, h - hl) < params.min_rows or not (v <= cut).any():
                            continue
                        gain = 0.5 * (s(gl, hl) + s(g - gl, h - hl) - s(g, h))
                        if gain > B.LEAST_GAIN and (best is None or gain > best[0]):
                            best = (gain, f, cut, missing_left, left)
            if best is None:
                w = -math.copysign(max(abs(g / scale) - params.l1, 0.0), g) / (h + params.l2) * params.step_size
                value[rows] = w
                return
            splits[node] = best[:4]
            left = set(best[4])
            grow(2 * node, best[4], depth + 1)
            grow(2 * node + 1, [i for i in rows if i not in left], depth + 1)

        grow(1, list(range(n)), 0)
        pred = pred + value
        trees.append(splits)
    return trees, pred


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.normal(size=120), rng.integers(0, 6, 120), rng.exponential(1e6, 120), rng.integers(-3, 3, 120) * 0.1, np.zeros(120)])
    x[rng.random(x.shape) < 0.1] = np.nan
    x[3, 0], x[4, 0], x[5, 3] = np.inf, -np.inf, -0.0
    y = 10 * np.nan_to_num(x[:, 0], posinf=3, neginf=-3) + 4 * np.nan_to_num(x[:, 1]) + np.where(np.isnan(x[:, 2]), 20, 0) + rng.normal(size=120)
    return x, y


NAMES = ["a", "b col", "c", "d", "e"]


def frame(spark, x, y, parts):
    data = [(i, *[None if np.isnan(v) and i % 2 else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id int, a double, `b col` double, c double, d double, e double, y double").repartition(parts)


@pytest.mark.parametrize("bins,l1,fraction", [(256, 2.0, 0.7), (5, 0.0, 1.0), (16, 30.0, 0.3)])
def test_trees_match_brute_force(spark, rows, bins, l1, fraction):
    x, y = rows
    params = B.BoostParams(rounds=3, max_depth=3, step_size=0.3, feature_fraction=fraction, l1=l1, bins=bins, min_rows=2)
    trees, pred = brute(x, y, params, NAMES)
    df = frame(spark, x, y, 3)
    model = B.fit_boosted(df, df, NAMES, "y", params)
    for tree, want in zip(model.trees, trees):
        assert set(tree.splits) == set(want)
        for n, (gain, f, cut, missing_left) in want.items():
            got = tree.splits[n]
            assert (got.feature, got.threshold) == (f, cut)
            assert got.gain == pytest.approx(gain, rel=1e-12)
            if np.isnan(x[:, f]).any() and got.missing_left != missing_left:
                assert got.gain == gain  # no missing value reached the node
    scored = {r["id"]: r["prediction"] for r in SC.score(df, model, ["id"]).collect()}
    assert [scored[i] for i in range(len(y))] == pytest.approx(pred, rel=1e-12)
    assert model.valid_rmse[-1] == pytest.approx(math.sqrt(((pred - y) ** 2).mean()))


def test_layout_changes_no_digit_and_storage_keeps_all(spark, rows, tmp_path):
    x, y = rows
    params = B.BoostParams(rounds=2, max_depth=3, l1=1.0, feature_fraction=0.6)
    one, many = (B.fit_boosted(frame(spark, x, y, p), None, NAMES, "y", params) for p in (1, 7))
    assert one == many and one.valid_rmse == []
    assert B.load_boosted(spark, B.save_boosted(spark, one, str(tmp_path / "m"))) == one


def test_cuts_are_exact_ranks(spark):
    rng = np.random.default_rng(1)
    values = [np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [np.inf, -np.inf, 0.0, -0.0]]), np.repeat(7.5, 504), np.full(504, np.nan), np.round(rng.normal(size=504), 1)]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in zip(*values)], "a double, b double, c double, d double").repartition(5)
    for bins in (2, 10, 256):
        for got, v in zip(B.quantile_cuts(df, ["a", "b", "c", "d"], bins), values):
            v = np.sort(v[~np.isnan(v)])
            want = sorted({float(v[-(-j * len(v) // bins) - 1]) + 0.0 for j in range(1, bins)}) if len(v) else []
            assert got.tolist() == want


def test_labels_and_empty_input(spark):
    bad = spark.createDataFrame([(1.0, 2.0), (2.0, None)], "x double, y double")
    with pytest.raises(ValueError, match="NULL or NaN"):
        B.fit_boosted(bad, None, ["x"], "y")
    with pytest.raises(ValueError, match="no rows"):
        B.fit_boosted(bad.limit(0), None, ["x"], "y")
    same = bad.withColumn("y", F.lit(0.0))
    model = B.fit_boosted(same, same, ["x"], "y", B.BoostParams(rounds=2))
    assert model.base == 0.0 and model.valid_rmse == [0.0, 0.0] and all(not t.splits for t in model.trees)
