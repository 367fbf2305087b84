"""Composed jobs and fixture edge cases."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.functions import math as M
from quarry.functions import text as TX
from quarry.operators import indexing as A
from quarry.operators import lm as LM
from quarry.operators import sampling as X
from quarry.plans import pipelines as E
from quarry.sources import readers as R


def dummy_sources(n_rows):
    return {"dummy": lambda s: R.dummy_instructions(s, n_rows).withColumn("row_key", F.monotonically_increasing_id().cast("string"))}


def keyed_dummy(spark, n):
    # deterministic row key from the instruction text itself
    return {"dummy": lambda s: R.dummy_instructions(s, n).withColumn("row_key", F.col("instruction"))}


@pytest.mark.parametrize("sample_size", [40, 1000])
def test_prepare_finetune_dataset(spark, tmp_path, sample_size):
    data = E.prepare_finetune_dataset(spark, "dummy", keyed_dummy(spark, 50), "row_key", str(tmp_path / "out"),
                                      max_length=64, sample_size=sample_size, vocab_size=500)
    counts = {r["step"]: r["n_rows"] for r in data.counts.collect()}
    n = min(sample_size, 50)
    assert counts["loaded"] == n and counts["filtered"] == n  # every prompt has >= 10 tokens
    assert (counts["train"], counts["validation"], counts["test"]) == (int(0.8 * n), int(0.1 * n), n - int(0.8 * n) - int(0.1 * n))
    train = data.train.load(spark)
    assert set(train.columns) == {"row_key", "input_ids", "attention_mask", "labels"}


def test_unknown_dataset(spark, tmp_path):
    with pytest.raises(ValueError):
        E.prepare_finetune_dataset(spark, "nope", keyed_dummy(spark, 5), "row_key", str(tmp_path))


def test_evaluate_lm_length_boundary(spark):
    # rows of 20 and 21 tokens: only the 21-token row gets a generation score
    rows = spark.createDataFrame(
        [("a", list(range(20)), 60), ("b", list(range(21)), 10)], "k string, input_ids array<bigint>, gen bigint"
    )
    lm = LM.fit_ngram_lm(rows, "k", tokens_col="input_ids", n=2)
    r = E.evaluate_lm(rows, lm, "k", num_samples=10, generated_len="gen").collect()[0]
    assert r["num_samples_evaluated"] == 2
    assert r["average_generation_score"] == pytest.approx(10 / 50)
    assert r["generation_score_std"] == 0.0


def test_evaluate_lm_empty(spark):
    rows = spark.createDataFrame([], "k string, input_ids array<bigint>")
    train = spark.createDataFrame([("a", [1, 2, 3])], "k string, input_ids array<bigint>")
    lm = LM.fit_ngram_lm(train, "k", tokens_col="input_ids", n=2)
    r = E.evaluate_lm(rows, lm, "k").collect()[0]
    assert r["num_samples_evaluated"] == 0 and r["average_perplexity"] == float("inf")


def test_coalesce_inputs_labels_default(spark):
    df = spark.createDataFrame([("a", [1, 2], None), ("b", [3], [9])], "k string, input_ids array<bigint>, labels array<bigint>")
    out = {r["k"]: r["labels"] for r in E.coalesce_inputs(df, None, "k").collect()}
    assert out == {"a": [1, 2], "b": [9]}


def test_load_text_splits(spark, tmp_path):
    rows = [(i, f"word{i % 7} other words here", i % 2, s) for i, s in enumerate(["train"] * 30 + ["validation"] * 5 + ["test"] * 5)]
    df = spark.createDataFrame(rows, "id long, sentence string, label long, split string")
    df.write.partitionBy("split").parquet(str(tmp_path / "splits"))
    vocab = TX.build_vocab(df, "sentence")
    out = E.load_text_splits(spark, str(tmp_path / "splits"), vocab, "id", fraction=0.5, max_length=16)
    kept = X.sample_fraction(df, 0.5, "id", 1).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in kept} == {k: v.count() for k, v in out.items() if v.count()}
    assert 0 < out["train"].count() < 30 and out["validation"].count() + out["test"].count() < 10
    r = out["train"].collect()[0]
    assert len(r["input_ids"]) == 16 and set(out["train"].columns) >= {"label", "token_type_ids"}


def test_argmax_ties_first(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([1.0, 2.0],)], "l array<float>")
    assert [r[0] for r in df.select(M.argmax("l")).collect()] == [0, 1]


def test_dense_index_gaps(spark):
    df = spark.createDataFrame([(5,), (100,), (5,), (7,), (10**12,)], "id long")
    got = {r["id"]: r["id_idx"] for r in A.dense_index(df, "id").collect()}
    assert got == {5: 0, 7: 1, 100: 2, 10**12: 3}


def test_one_row_and_empty_splits(spark):
    one = spark.createDataFrame([(1,)], "k long")
    t, v = X.train_test_split(one, 0.25, key="k")
    assert (t.count(), v.count()) == (0, 1)
    empty = spark.createDataFrame([], "k long")
    t, v = X.train_test_split(empty, 0.25, key="k")
    assert (t.count(), v.count()) == (0, 0)
    assert X.sample_n(empty, 5, "k").count() == 0
