import math

from pyspark.sql import functions as F

from quarry.functions import math as M
from quarry.operators import metrics as MT


def test_mcc_matches_formula(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)], "y int, p int")
    r = MT.mcc(df, "y", "p").collect()[0]
    tp, tn, fp, fn = 2, 2, 1, 1
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (tp, tn, fp, fn)
    assert abs(r["mcc"] - (tp * tn - fp * fn) / math.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))) < 1e-12


def test_mcc_zero_denominator(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "y int, p int")
    assert MT.mcc(df, "y", "p").collect()[0]["mcc"] == 0.0


def test_eval_summary_empty_and_population_std(spark):
    empty = spark.createDataFrame([], "perplexity double, generation_score double")
    r = MT.eval_summary(empty).collect()[0]
    assert r["num_samples_evaluated"] == 0 and r["average_perplexity"] == float("inf") and r["perplexity_std"] == 0.0
    df = spark.createDataFrame([(1.0, None), (3.0, 0.5)], "perplexity double, generation_score double")
    r = MT.eval_summary(df).collect()[0]
    assert r["perplexity_std"] == 1.0 and r["average_generation_score"] == 0.5 and r["generation_score_std"] == 0.0


def test_dataset_stats(spark):
    df = spark.createDataFrame([(2, [1, 2, 3]), (1, [1] * 10)], "k int, input_ids array<bigint>")
    r = MT.dataset_stats(df, "k").collect()[0]
    assert (r["num_samples"], r["sample_input_ids_length"], r["min_length"], r["max_length"]) == (2, 10, 3, 10)
    e = MT.dataset_stats(df.where("k > 5"), "k").collect()[0]
    assert e["num_samples"] == 0 and e["columns"] is None


def test_best_run_tie_earliest(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.3), (3, 0.3)], "epoch int, val_loss double")
    assert MT.best_run(df, "val_loss").collect()[0]["epoch"] == 2
    assert MT.best_run(df, "val_loss", "max").collect()[0]["epoch"] == 1


def test_round_half_up(spark):
    df = spark.createDataFrame([("a", 2.00005)], "metric string, value double")
    assert MT.round_metrics(df).collect()[0]["value"] == 2.0001


def test_functions(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9], list(range(21)), 60)], "l array<double>, ids array<bigint>, g int")
    r = df.select(
        M.argmax("l").alias("a"), M.prompt_half("ids").alias("h"), M.generation_score("g").alias("s"), M.sigmoid(F.lit(0.0)).alias("z")
    ).collect()[0]
    assert r["a"] == 1 and r["h"] == list(range(10)) and r["s"] == 1.0 and r["z"] == 0.5
