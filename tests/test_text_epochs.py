"""Text classifier by epochs: gradient, resumption, checkpoints."""

import math

import numpy as np
import pytest

from quarry.operators import metrics as MT
from quarry.operators import scoring as SC
from quarry.operators import text_epochs as TE
from quarry.sources.checkpoints import CheckpointStore

PARAMS = TE.EpochParams(epochs=3, steps=2, num_features=512)


def rows(n=120):
    return [(i, ("red apple pear " if i % 2 else "blue stone iron ") * (1 + i % 3) + f"word{i % 7}", i % 2) for i in range(n)] + [(900, None, 1), (901, "", 0), (902, "red", None)]


def frames(spark):
    df = spark.createDataFrame(rows(), "id long, text string, label int")
    return df.where("id % 4 <> 0"), df.where("id % 4 = 0")


def test_gradient_matches_differences(spark):
    train, _ = frames(spark)
    counts = TE.word_counts(train, "id", "text", "label", 64, 1, 1)
    rng = np.random.default_rng(1)
    model = TE.TextModel(rng.normal(size=65), np.zeros(65), rng.random(64))
    g, n = TE.gradient(counts, model)
    assert n == train.where("label is not null").count()
    for i in [*np.flatnonzero(g)[:4], 64]:
        loss = []
        for step in (1e-5, -1e-5):
            w = model.weights.copy()
            w[i] += step
            loss.append(TE.mean_loss(counts, TE.TextModel(w, model.squares, model.idf)) * n)
        assert g[i] == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-4, abs=1e-6)


def test_a_stopped_fit_goes_on_to_the_same_model(spark, tmp_path):
    train, valid = frames(spark)
    straight, losses = TE.fit_text_epochs(train, valid, "id", params=PARAMS)
    store = CheckpointStore(str(tmp_path / "s"))
    TE.fit_text_epochs(train.repartition(5), valid, "id", params=TE.EpochParams(epochs=1, steps=2, num_features=512), store=store)
    resumed, again = TE.fit_text_epochs(train.repartition(2), valid, "id", params=PARAMS, store=store)
    assert [tuple(r) for r in again.collect()] == [(e, pytest.approx(v, rel=1e-9)) for e, v in losses.collect()]
    for a, b in ((straight.weights, resumed.weights), (straight.squares, resumed.squares), (straight.idf, resumed.idf)):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-12)
    values = [r["eval_loss"] for r in losses.collect()]
    assert values == sorted(values, reverse=True) and values[-1] < math.log(2)
    scored = SC.score(valid.where("label is not null"), resumed, ["id", "label"])
    assert MT.mcc(scored, "label", "prediction").first()["mcc"] > 0.9
    # the scores follow from the state: the loss again, from logits
    p = {r["id"]: (r["logits"], r["label"]) for r in scored.collect()}
    own = [math.log1p(math.exp(-(z[1] - z[0]) * (1 if y else -1))) for z, y in p.values()]
    assert np.mean(own) == pytest.approx(values[-1], rel=1e-4)


def test_store_keeps_best_and_last_and_refuses_other_fits(spark, tmp_path):
    store = CheckpointStore(str(tmp_path / "c"), "one fit")
    assert store.last(spark) is None and store.best(spark) is None and store.prune(spark) == []
    for step, metric in ((1, 3.0), (2, 1.0), (3, 2.0), (4, 1.0), (5, 4.0)):
        store.publish(spark, step, {"t": spark.range(step)}, metric)
    assert (store.last(spark)["step"], store.best(spark)["step"]) == (5, 2)
    assert CheckpointStore(store.root, "one fit", "max").best(spark)["step"] == 5
    assert store.prune(spark) == [2, 5] == store.prune(spark)
    assert store.load(spark, store.best(spark), "t").count() == 2 and store.load(spark, store.last(spark), "t").count() == 5
    assert [r["step"] for r in store.steps(spark).orderBy("step").collect()] == [1, 2, 3, 4, 5]
    spark.range(9).write.parquet(f"{store.root}/step-6-lost/t")  # written, never published
    assert store.last(spark)["step"] == 5
    with pytest.raises(ValueError, match="other settings"):
        CheckpointStore(store.root, "another").last(spark)
    train, valid = frames(spark)
    with pytest.raises(ValueError, match="other settings"):
        TE.fit_text_epochs(train, valid, "id", params=PARAMS, store=store)


def test_batches_become_objects_in_small_pieces():
    import pyarrow as pa

    from quarry.operators import text_epochs as TE

    batch = pa.RecordBatch.from_pydict({"words": [["a"] * 40] * 5000 + [["b" * 100] * 5000] * 3})
    parts = list(TE._parts(iter([batch])))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or (p.num_rows <= TE.PART_ROWS and p.nbytes <= TE.PART_BYTES) for p in parts)
