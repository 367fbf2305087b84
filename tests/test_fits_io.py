"""Fits beat the mean predictor on data with signal; sources and sinks behave."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_ORACLE
from quarry.operators import learners as L
from quarry.operators import metrics as MT
from quarry.operators import mlp as MLP
from quarry.operators import sampling as X
from quarry.plans import queries as Q
from quarry.sources import readers as R
from quarry.sources import sinks as S


def _mean_mse(train, valid):
    mu = train.agg(F.avg("target")).collect()[0][0]
    return valid.agg(F.avg(F.pow(F.col("target") - F.lit(mu), 2))).collect()[0][0]


def test_gbt_beats_mean(spark):
    df = Q.doc_features(spark, SF_ORACLE)
    train, valid = X.train_test_split(df, 0.25, key="doc_id", seed=1)
    res = L.fit_gbt(train, valid, Q.FIT_FEATURES, "target")
    assert len(res.valid_rmse) == 10
    assert res.valid_rmse[-1] ** 2 < 0.5 * _mean_mse(train, valid)


def test_mlp_learns(spark):
    df = Q.doc_features(spark, SF_ORACLE)
    train, valid = X.train_test_split(df, 0.25, key="doc_id", seed=1)
    model = MLP.fit_mlp(train, Q.FIT_FEATURES, "target", lr=0.01, steps=40)
    assert model.history[-1] < model.history[0]
    scored = MLP.score_mlp(valid, model, keep=["target"])
    mse = MT.mse(scored, "target", "prediction").collect()[0]["mse"]
    assert mse < _mean_mse(train, valid)


def test_mlp_model_factory(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(40)], "x double, y double")
    by_default, by_path = (MLP.fit_mlp(df, ["x"], "y", steps=2, **kw) for kw in ({}, {"factory": "quarry.operators.mlp.init_weights"}))
    assert all(np.array_equal(a, b) for a, b in zip(by_default.weights, by_path.weights))
    zeros = MLP.fit_mlp(df, ["x"], "y", steps=1, factory=lambda sizes, seed: [np.zeros_like(w) for w in MLP.init_weights(sizes, seed)])
    assert not zeros.weights[0].any()
    for wrong in ("quarry.operators.mlp.nothing", "no.such.module", "plain", "quarry.operators.mlp.MLP_HIDDEN"):
        with pytest.raises(ValueError):
            MLP.factory_of(wrong)


def test_mlp_save_load_roundtrip(spark, tmp_path):
    model = MLP.mlp_from_fixed(["a", "b"], "y", [2, 3, 1])
    S.save_mlp(spark, model, str(tmp_path / "m"))
    back = S.load_mlp(spark, str(tmp_path / "m"))
    for w1, w2 in zip(model.weights, back.weights):
        assert np.allclose(w1, w2)


def test_als_low_rank(spark):
    rng = np.random.default_rng(0)
    u, v = rng.normal(size=(40, 2)), rng.normal(size=(30, 2))
    rows = [(i, j, float(1 / (1 + np.exp(-u[i] @ v[j])))) for i in range(40) for j in range(30)]
    df = spark.createDataFrame(rows, "user_idx int, item_idx int, rating_norm double")
    train, valid = X.train_test_split(df, 0.2, key=["user_idx", "item_idx"], seed=1)
    model = L.fit_recommender(train, rank=4, iterations=10, reg=0.01)
    mse = MT.mse(L.score_recommender(model, valid), "rating_norm", "prediction").collect()[0]["mse"]
    mu = train.agg(F.avg("rating_norm")).collect()[0][0]
    base = valid.agg(F.avg(F.pow(F.col("rating_norm") - mu, 2))).collect()[0][0]
    assert mse < 0.5 * base


def test_text_classifier(spark):
    docs = Q.table(spark, SF_ORACLE, "documents").select("doc_id", "text", (F.col("lang") == "en").cast("int").alias("label"))
    train, valid = Q.X.train_test_split(docs, 0.25, key="doc_id", seed=1)
    r = Q.MT.mcc(Q.L.classify(Q.L.fit_text_classifier(train), valid, ["label"]), "label", "prediction").collect()[0]
    acc = (r["tp"] + r["tn"]) / (r["tp"] + r["tn"] + r["fp"] + r["fn"])
    assert acc > 0.9 and r["mcc"] > 0.8


def test_tsv_failfast(spark, tmp_path):
    p = tmp_path / "bad.tsv"
    p.write_text("1\t2\t3\t4\nx\t2\t3\t4\n")
    with pytest.raises(Exception):
        R.read_ratings_tsv(spark, str(p)).collect()


def test_first_available(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    df = R.read_first_available(spark, [str(tmp_path / "nope"), good], lambda s, p: s.read.parquet(p))
    assert df.count() == 3
    fb = R.read_first_available(spark, [str(tmp_path / "nope")], lambda s, p: s.read.parquet(p), lambda s: s.range(1))
    assert fb.count() == 1
    with pytest.raises(FileNotFoundError):
        R.read_first_available(spark, [str(tmp_path / "nope")], lambda s, p: s.read.parquet(p))


def test_load_instructions_unknown(spark):
    with pytest.raises(ValueError):
        R.load_instructions(spark, "nope", 10, {"a": lambda s: s.range(1)})


def test_dummy_instructions(spark):
    df = R.dummy_instructions(spark, 5000)
    assert df.count() == 1000
    r = df.where("instruction like '%country 7?'").collect()[0]
    assert r["output"] == "The capital of country 7 is City 7." and r["input"] == ""


def test_find_artifact(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "model.ubj").write_bytes(b"xyz")
    (tmp_path / "a" / "other.txt").write_bytes(b"1")
    r = R.find_artifact(spark, str(tmp_path), "model.ubj").collect()[0]
    assert r["path"].endswith("a/b/model.ubj") and r["length"] == 3
    r2 = R.find_artifact(spark, str(tmp_path / "a"), "none.bin").collect()[0]
    assert r2["length"] in (1, 3)
    with pytest.raises(FileNotFoundError):
        R.find_artifact(spark, str(tmp_path / "missing"))


def test_push_all_captures_errors(spark):
    def boom():
        raise RuntimeError("no")

    rows = S.push_all(spark, [S.PushItem("a", "p", lambda: "v"), S.PushItem("b", "p", boom)]).collect()
    assert rows[0]["success"] and not rows[1]["success"] and "RuntimeError" in rows[1]["error"]


def test_run_id():
    assert S.run_id_of("s3://b/models/run-7/") == "run-7"


def test_entry_smoke(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "validation"}
    assert sum(r["n_rows"] for r in rows) == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_score_dispatch(spark):
    from quarry.operators.scoring import score

    df = spark.createDataFrame([(1, 1.0, 2.0)], "k int, a double, b double")
    model = MLP.mlp_from_fixed(["a", "b"], "y", [2, 3, 1])
    out = score(df, model, ["k"])
    assert out.columns == ["k", "prediction"]

    class Const:
        def score(self, df, keep):
            return df.select(*keep, F.lit(0.5).alias("p"))

    assert score(df, Const(), ["k"]).collect()[0]["p"] == 0.5
    with pytest.raises(TypeError):
        score(df, object(), ["k"])


def test_classifier_best_epoch(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select(
        "doc_id", "text", (F.col("lang") == "en").cast("int").alias("label"))
    train, valid = X.train_test_split(docs, 0.25, key="doc_id", seed=1)
    model, hist = L.fit_text_classifier_epochs(train, valid, epochs=2, iters_per_epoch=5, num_features=1 << 14)
    rows = {r["epoch"]: r["eval_loss"] for r in hist.collect()}
    assert set(rows) == {1, 2} and all(v > 0 for v in rows.values())
    best = min(rows, key=lambda e: (rows[e], e))
    assert L.eval_loss(model, valid) == pytest.approx(rows[best])


def test_als_has_few_blocks(spark):
    """Each iteration sends a vector to every block that rates it: what is shuffled grows with the blocks."""
    from quarry.operators import learners as L

    rows = spark.createDataFrame([(u, i, float((u + i) % 5) / 4) for u in range(20) for i in range(20)], "user_idx int, item_idx int, rating_norm double")
    model = L.fit_recommender(rows, iterations=1)
    # the factors stay in their blocks
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == L.ALS_BLOCKS == 4
