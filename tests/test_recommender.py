"""Rating model: gradients, blocks, shared rows, cold rows, storage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import learners as L
from quarry.operators import recommender as R
from quarry.operators import scoring as SC


def ratings(seed=0, users=60, items=50, hot=True):
    rng = np.random.default_rng(seed)
    u, v = rng.normal(size=(users, 2)), rng.normal(size=(items, 2))
    rows = [(a, b, float(1 / (1 + np.exp(-2 * u[a] @ v[b])))) for a in range(users) for b in range(items) if b == 7 or a == 3 or rng.random() < 0.4]
    if hot:  # one item and one user with a fifth of all ratings each
        rows += [r for r in rows if r[1] == 7 or r[0] == 3] * 7
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "user_idx long, item_idx long, rating_norm double").repartition(parts)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(1)
    params = R.RatingParams(rank=3, hidden=5)
    head, x, y = params.head(), rng.normal(size=(6, 6)), rng.random(6)
    loss = lambda x, head: (R.forward(x, head)[-1][:, 0] - y) ** 2
    grads, by_input = R.gradients(x, y, head)
    for k, g in enumerate(grads):
        at = tuple(s // 2 for s in g.shape)
        up, down = [a.copy() for a in head], [a.copy() for a in head]
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        assert g[at] == pytest.approx((loss(x, up).mean() - loss(x, down).mean()) / 2e-6, rel=1e-4, abs=1e-9)
    up, down = x.copy(), x.copy()
    up[2, 1] += 1e-6
    down[2, 1] -= 1e-6
    assert by_input[2, 1] == pytest.approx((loss(up, head)[2] - loss(down, head)[2]) / 2e-6, rel=1e-4, abs=1e-9)


@pytest.mark.parametrize("blocks", [1, 3])
def test_learns_and_layout_changes_nothing(spark, blocks):
    rows = ratings()
    params = R.RatingParams(rank=6, hidden=16, epochs=12, batch=32, blocks=blocks, rate=0.1)
    models = [R.fit_ratings(frame(spark, rows, p), params) for p in ((1, 5) if blocks == 3 else (2,))]
    spread = np.var([r[2] for r in rows])
    for model in models:
        got = SC.score(frame(spark, rows), model, ["rating_norm"]).agg(F.avg(F.pow(F.col("prediction") - F.col("rating_norm"), 2)).alias("mse"), F.count("*").alias("n")).first()
        assert got["n"] == len(rows) and got["mse"] < 0.5 * spread
        assert (model.hot_users, model.hot_items) == (([3], [7]) if blocks == 3 else ([], []))
    if len(models) == 2:
        a, b = ({r["idx"]: r["vec"] for r in m.users.collect()} for m in models)
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-9) for k in a)
        assert all(np.allclose(x, y, atol=1e-9) for x, y in zip(models[0].head, models[1].head))


def test_each_rating_is_used_once_an_epoch(spark, monkeypatch):
    """Every vector is stepped as often as it has ratings, and every head's rows add up to all."""
    rows = ratings(seed=2) + [(3, 7, 0.5)] * 5
    seen = []
    plain = R.materialize

    def watched(df):
        out = plain(df)
        if "n" in out.columns and "vec" in out.columns:
            seen.append(out)
        return out

    monkeypatch.setattr(R, "materialize", watched)
    model = R.fit_ratings(frame(spark, rows), R.RatingParams(rank=2, hidden=3, epochs=1, blocks=4))
    assert model.hot_users and model.hot_items and len(seen) == 4
    counts = {}
    for df in seen:
        for r in df.collect():
            kind = {R.SHARED_USER: R.USER, R.SHARED_ITEM: R.ITEM}.get(r["kind"], r["kind"])
            counts[kind, r["idx"]] = counts.get((kind, r["idx"]), 0) + r["n"]
    want = {(R.HEAD, 0): len(rows)}
    for u, i, _ in rows:
        want[R.USER, u] = want.get((R.USER, u), 0) + 1
        want[R.ITEM, i] = want.get((R.ITEM, i), 0) + 1
    assert counts == want
    # vectors of all users and items come out
    assert model.users.count() == model.n_users == len({r[0] for r in rows}) and model.items.count() == model.n_items


def test_cold_rows_nulls_and_storage(spark, tmp_path):
    rows = ratings(seed=4, users=10, items=8, hot=False)
    dirty = [*rows, (None, 1, 0.5), (1, None, 0.5), (1, 1, None), (1, 1, float("nan"))]
    model = R.fit_ratings(frame(spark, dirty), R.RatingParams(rank=3, hidden=4, epochs=2, blocks=2))
    loaded = R.load_ratings_model(spark, R.save_ratings_model(model, str(tmp_path / "m")))
    asked = spark.createDataFrame([(1, 1, "known"), (99, 1, "cold user"), (1, 99, "cold item"), (99, 99, "both"), (None, 99, "null")], "user_idx long, item_idx long, name string")
    a, b = ({r["name"]: r["prediction"] for r in m.score(asked, ["name"]).collect()} for m in (model, loaded))
    assert a == b and len(a) == 5 and all(0 <= v <= 1 for v in a.values())
    assert a["both"] == a["null"] == pytest.approx(R.forward(np.zeros((1, 6)), model.head)[-1][0, 0])
    with pytest.raises(ValueError):
        R.fit_ratings(frame(spark, []))


def test_rounds_move_single_precision_and_few_blocks(spark, monkeypatch):
    """What a round writes for a user or item is 4 bytes a number, and 600,000 ratings make no 4 blocks."""
    schemas, plain = [], R.materialize
    monkeypatch.setattr(R, "materialize", lambda df: schemas.append(df.schema) or plain(df))
    R.fit_ratings(frame(spark, ratings(seed=5, users=12, items=9, hot=False)), R.RatingParams(rank=2, hidden=3, epochs=1, blocks=2))
    written = [s["vec"].dataType.elementType.typeName() for s in schemas if "vec" in s.names]
    assert len(written) == 3 and set(written) == {"float"}
    assert -(-600_000 // R.CELL_ROWS) < 4


def test_errors_recomputed_in_batches(spark):
    """The check of the model's error is matrix products on Arrow batches, no expression of 8,000 terms a row."""
    from quarry.plans import fit_queries as Q

    both = frame(spark, ratings(seed=6, users=12, items=9, hot=False) + [(99, 1, 0.5), (1, 99, 0.5)]).withColumn("split", F.lit("train"))
    model = R.fit_ratings(both, R.RatingParams(rank=3, hidden=4, epochs=2))
    out = Q._rating_errors(spark, model, both, "ratings-test")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "zip_with" not in plan
    want = model.score(both, ["rating_norm"]).agg(F.avg(F.pow(F.col("prediction") - F.col("rating_norm"), 2.0))).first()[0]
    assert out.first()["own"] == pytest.approx(want, abs=1e-12)


def test_many_vectors_are_not_broadcast(spark, monkeypatch):
    """Vectors beyond ``BROADCAST_BYTES`` go to cells: the same scores, for frequent, unknown and NULL ones too."""
    rows = ratings(seed=5)
    model = R.fit_ratings(frame(spark, rows), R.RatingParams(rank=4, hidden=8, epochs=1, blocks=3))
    assert model.hot_users and model.hot_items
    own = spark.createDataFrame([(n, *r) for n, r in enumerate([(u, i) for u, i, _ in rows] + [(10_000, 7), (3, None), (None, 10_000), (None, None)])], "n int, user_idx long, item_idx int").repartition(5)
    small = [{r["n"]: r for r in df.collect()} for df in (model.with_vectors(own), model.score(own, ["n"]))]
    model.n_users = 900_000
    assert "Broadcast" not in model.score(own, ["n"])._jdf.queryExecution().toString()
    monkeypatch.setattr(R, "SCORED_ENTITIES", 300_000)
    large = [{r["n"]: r for r in df.collect()} for df in (model.with_vectors(own), model.score(own, ["n"]))]
    assert large[0].keys() == small[0].keys() and all(large[0][n].asDict() == small[0][n].asDict() for n in small[0])
    assert large[1].keys() == small[1].keys() and all(large[1][n]["prediction"] == pytest.approx(small[1][n]["prediction"], abs=1e-12) for n in small[1])


def test_als_drops_what_it_sent(spark, monkeypatch):
    made = []
    monkeypatch.setattr(L, "ALS", lambda f=L.ALS, **params: made.append(f(**params)) or made[-1])
    L.fit_recommender(frame(spark, ratings()), rank=2, iterations=3)
    assert made[0].getCheckpointInterval() == 2
