"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, norm2 int"


def brute(rows, every, k=5, m=5, bounds=H.Bounds()):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = (label, tuple(math.floor(256 * c) for c in v))
        own[i] = min(own.get(i, x), x)
    out = set()
    for a, (label, x) in own.items():
        if a % every:
            continue
        score = sorted((-sum(p * q for p, q in zip(x, y)), i) for i, (_, y) in own.items() if i != a)
        for s, i in [(s, i) for s, i in score if own[i][0] == label][:k]:
            found = [(n, j) for n, j in score if own[j][0] != label and bounds.low * -s <= bounds.of * -n <= bounds.high * -s]
            out |= {(a, i, r + 1, j, -s, -n) for r, (n, j) in enumerate(found[:m])}
    return out


def mined(spark, rows, every, parts=3, **options):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(parts)
    return {tuple(r) for r in H.mine(df, F.col("vec_id") % every == 0, **options).collect()}


def vectors(seed, n, d, labels, lengths):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * lengths(rng, n)[:, None]
    centre = rng.normal(size=(labels, d))
    own = rng.integers(0, labels, n)
    return [(i, (0.8 * x[i] + 0.2 * centre[own[i]]).tolist(), int(own[i])) for i in range(n)]


@pytest.mark.parametrize("lengths", [lambda r, n: np.ones(n), lambda r, n: r.lognormal(0, 1, n)], ids=["equal", "varied"])
def test_matches_all_pairs(spark, monkeypatch, lengths):
    monkeypatch.setattr(H, "BUCKET_CELLS", 0)  # buckets of 64 rows
    monkeypatch.setattr(H, "ANCHOR_CELLS", 0)
    monkeypatch.setattr(H, "TOGETHER", 7)
    rows = vectors(1, 700, 12, 4, lengths)
    want = brute(rows, 9)
    assert len(want) > 300
    assert mined(spark, rows, 9) == want


def test_copies_ties_bad_rows_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(H, "BUCKET_CELLS", 0)
    rows = vectors(2, 200, 5, 3, lambda r, n: np.ones(n))
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(150)]  # a large group of copies of one vector
    rows += [(3000 + i, [0.0] * 5, i % 2) for i in range(30)]  # vectors of no length
    rows += [(4000 + i, [1.0, 0.0, 0.0, 0.0, 0.0] if i % 2 else [0.0, 1.0, 0.0, 0.0, 0.0], i % 3) for i in range(20)]  # scores of zero
    rows += [(7, rows[9][1], 2), (7, rows[3][1], 0), (14, rows[14][1], rows[14][2])]
    rows += [(None, rows[3][1], 1), (5001, None, 1), (5002, rows[3][1], None), (5003, [float("nan")] * 5, 1), (5004, [None, 0.0, 0.0, 0.0, 1.0], 1), (5005, [float("inf")] * 5, 1), (5006, [], 0)]
    assert mined(spark, rows, 7) == brute(rows, 7)
    assert mined(spark, rows, 7, parts=1, positives=3, negatives=2, bounds=H.Bounds(50, 90, 100)) == brute(rows, 7, 3, 2, H.Bounds(50, 90, 100))


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=3) * 1e6).tolist(), i % 2) for i in range(60)]  # squared lengths near 2^56
    want = brute(rows, 5)
    assert max(s for *_, s in want) > 1 << 54
    assert mined(spark, rows, 5) == want


def test_candidates_hold_every_row_that_reaches_the_least_score():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(400, 4)) * rng.lognormal(3, 0.03, (400, 1))).astype(np.int64)
    bucket = H.Bucket(np.arange(400), np.zeros(400, int), x)
    cut = 0
    for q in x[:50]:
        score = x @ q
        for share in (0.3, 0.9, 0.99, 1.0):
            least = share * score.max()
            got = bucket.candidates(q.astype(float), float(np.linalg.norm(q)), least)
            assert set(np.flatnonzero(score >= least)) <= set(range(400) if got is None else got.tolist())
            cut += 400 - (400 if got is None else len(got))
    assert cut > 20_000  # and leave many out


def test_empty_table_few_rows_and_bounds(spark):
    assert mined(spark, [], 2) == set()
    assert mined(spark, [(1, [1.0], 0)], 2) == set()
    assert mined(spark, [(0, [1.0], 0), (2, [1.0], 1)], 2) == set()
    with pytest.raises(ValueError):
        mined(spark, [], 2, bounds=H.Bounds(90, 80, 100))
