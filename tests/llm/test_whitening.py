"""Whitening against integer brute force and numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, whitened string, n int"


def brute(rows, d, components):
    """Of every usable row: integers; of the distinct ones: n, sums, scatter, eigenpairs."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    own = sorted({tuple(x) for _, x in kept})
    n, sums = len(own), [sum(c) for c in zip(*own)]
    centred = [[sum(n * n * x[a] * x[b] for x in own) - n * sums[a] * sums[b] for b in range(d)] for a in range(d)]
    cov = np.array([[v / n**3 for v in row] for row in centred])
    values, axes = np.linalg.eigh(cov)
    return kept, own, n, sums, cov, values[::-1][:components], axes[:, ::-1][:, :components]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 6)) * [3, 2.5, 1, 0.5, 0.2, 0.1] + [40, -7, 0, 0, 1, 0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # copies count once in the fit
    rows += [(5, rows[5][1]), (None, rows[7][1])]
    bad = [(2000, None), (2001, [float("nan")] + [0.0] * 5), (2002, [float("inf")] + [0.0] * 5), (2003, [None] + [0.0] * 5), (2004, [1.0, 2.0]), (2005, [])]
    return rows, spark.createDataFrame([(*r, "clash", 9) for r in rows + bad], SCHEMA)


@pytest.mark.parametrize("parts", [1, 5])
def test_matches_brute_force(spark, table, parts, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 64)
    rows, df = table
    kept, own, n, sums, cov, values, axes = brute(rows, 6, 4)
    got = W.whitened(df.repartition(parts), 4).collect()
    assert len(got) == 4 * len(kept)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    of = {}
    for i, x in kept:
        of.setdefault(i, []).append(x)
    sign = {}
    for (i, c), rs in by.items():
        assert len(rs) == len(of[i])  # repeated rows are each returned
        x = of[i][0]
        for r in rs:
            assert r["n"] == n
            assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums))
            want = sum((a - s / n) * v for a, s, v in zip(x, sums, axes[:, c - 1])) / math.sqrt(values[c - 1])
            s = sign.setdefault(c, 1 if r["whitened"] * want >= 0 else -1)
            assert r["whitened"] == pytest.approx(s * want, abs=1e-8)
            assert r["explained"] == pytest.approx(values[c - 1] / cov.trace(), rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-8


def test_products_are_exact_at_any_width():
    rng = np.random.default_rng(4)
    for top in (1, 2, 300, 1 << 20, 1 << 39):
        x = rng.integers(-top, top, (130, 5))
        x[:, 2] = 17  # no bits at all
        low = x.min(0)
        bits = np.maximum([int(b).bit_length() for b in x.max(0) - low], 1)
        y = (x - low).astype(object)
        assert (np.triu(W.sliced_products(W.bit_planes(x, low, bits), bits)) == np.triu(y.T @ y)).all()


def test_sums_are_exact_and_shift_changes_no_covariance(spark, table):
    rows, df = table
    vectors = {s: W.usable(df, 256, s)[0].select("x").distinct() for s in (0, 1000)}
    fits = {s: W.fit(v, 6, 4) for s, v in vectors.items()}
    assert fits[0].scatter == fits[1000].scatter
    assert [b - a for a, b in zip(fits[0].sums, fits[1000].sums)] == [1000 * fits[0].n] * 6


def test_large_entries_stay_exact(spark):
    rows = [(0, [3e8, 1.0]), (1, [-3e8, 2.0]), (2, [1e8, -5.0]), (3, [1e30, 0.0])]  # the last has no 40-bit integer
    got = {(r["vec_id"], r["component"]): r for r in W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2).collect()}
    _, own, n, sums, _, _, _ = brute([(i, v) for i, v in rows[:3]], 2, 2)
    x = {i: [math.floor(256 * c) for c in v] for i, v in rows[:3]}
    assert {i for i, _ in got} == {0, 1, 2}
    for i in range(3):
        assert int(got[i, 1]["deviation"]) == sum((3 * a - sum(x[j][k] for j in range(3))) ** 2 for k, a in enumerate(x[i]))


def test_little_or_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert W.whitened(empty).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert W.whitened(same).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<float>")
    got = W.whitened(line).collect()  # one direction only
    assert len(got) == 5 and {r["component"] for r in got} == {1}
    assert got[0]["explained"] == pytest.approx(1.0)


def test_query_columns(spark):
    from quarry.llm.queries import QUERIES

    df = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    assert df.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(df.dtypes)["deviation"] == "bigint"
    one = df.agg(F.countDistinct("identity_error").alias("k"), F.max("identity_error").alias("e"), F.count_if(F.col("deviation").isNull()).alias("bad")).first()
    assert one["k"] == 1 and one["e"] < 1e-4 and one["bad"] == 0
