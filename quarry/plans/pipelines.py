"""End-to-end jobs composed from the operators (one Spark application each).

Data moves between steps as parquet ``DatasetHandle``s under ``out_root`` (a
shared folder on a cluster); nothing is converted to pandas on the driver.
Every job returns a small result frame (metrics or push results).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import fixed as fx
from quarry.functions import math as M
from quarry.functions import text as TX
from quarry.operators import columns as P
from quarry.operators import indexing as A
from quarry.operators import boosting as B
from quarry.operators import learners as L
from quarry.operators import lm as LM
from quarry.operators import metrics as MT
from quarry.operators import mlp as MLP
from quarry.operators import recommender as RM
from quarry.operators import sampling as X
from quarry.operators import text_epochs as TE
from quarry.operators.keys import with_hash_key
from quarry.operators.layout import materialize, stored
from quarry.sources import readers as R
from quarry.sources import sinks as S
from quarry.sources.cache import SourceCache
from quarry.sources.checkpoints import CheckpointStore


# ------------------------------------------------------------ E1, E2


@dataclass
class Prepared:
    train: R.DatasetHandle
    validation: R.DatasetHandle


def feature_prep(df: DataFrame, columns: str, target: tuple[str, str], key, out_root: str,
                 test_size: float = fx.TEST_SIZE, seed: int = fx.TABULAR_SEED, keep_key: list[str] | None = None) -> Prepared:
    """E1: rename the target, select the comma list, seeded split, save both splits."""
    cols = P.parse_columns(columns)
    renamed = P.rename(df, {target[0]: target[1]})
    key_names = [key] if isinstance(key, str) else [k for k in key if isinstance(k, str)]
    extra = [k for k in (keep_key or []) + key_names if k not in cols]
    selected = renamed.select(*dict.fromkeys(extra), *cols)
    train, valid = X.train_test_split(selected, test_size, key=key, seed=seed)
    return Prepared(
        R.DatasetHandle.save(train.select(*cols), f"{out_root}/feature_prep/train"),
        R.DatasetHandle.save(valid.select(*cols), f"{out_root}/feature_prep/validation"),
    )


def preprocess(spark: SparkSession, cast_float_columns: str, data: Prepared, out_root: str) -> Prepared:
    """E2: load both splits, cast the listed columns (label included) to float, save."""
    cols = P.parse_columns(cast_float_columns)
    out = {}
    for name, h in (("train", data.train), ("validation", data.validation)):
        out[name] = R.DatasetHandle.save(P.cast_float(h.load(spark), cols), f"{out_root}/preprocess/{name}")
    return Prepared(out["train"], out["validation"])


# ------------------------------------------------------------ E3


@dataclass
class FinetuneData:
    train: R.DatasetHandle
    validation: R.DatasetHandle
    test: R.DatasetHandle
    vocab: TX.Vocab
    counts: DataFrame


def prepare_finetune_dataset(spark: SparkSession, dataset_name: str, sources: dict, key: str, out_root: str,
                             max_length: int = 2048, sample_size: int = 10000, vocab_size: int | None = None,
                             seed: int = fx.SHUFFLE_SEED) -> FinetuneData:
    """E3: load by name, seeded sample, prompt text, tokenise, length filter, 80/10/10, save.

    When a sample was taken, the 80/10/10 positions follow the seeded
    shuffled order; otherwise the source order given by ``key``.
    """
    raw = R.load_instructions(spark, dataset_name, sample_size, sources)
    keyed, sampled, n_loaded = X.sample_n_counted(raw, sample_size, key, seed)
    loaded = keyed.drop("_qk", "_qh")
    prompts = TX.format_prompt(loaded, keep=[key])
    vocab = TX.build_vocab(prompts, "text", vocab_size)
    tok = TX.tokenise(prompts, vocab, max_length, key=key)
    kept = materialize(P.filter_length(tok, "input_ids", 10, max_length))
    if sampled:
        parts = X.sequential_split_hashed(with_hash_key(kept, key, seed))
    else:
        parts = X.sequential_split(kept, [key])
    handles = {name: R.DatasetHandle.save(df, f"{out_root}/finetune/{name}") for name, df in parts.items()}
    # Exact counts without extra passes over the tokenised data: the sample
    # size is known from the cut-off search, tokenising keeps one row per
    # (unique) key, the filtered rows are counted from their checkpoint and
    # the splits from their parquet footers.
    rows = [
        ("loaded", n_loaded),
        ("tokenised", n_loaded),
        ("filtered", kept.count()),
        *[(name, h.load(spark).count()) for name, h in handles.items()],
    ]
    counts = spark.createDataFrame(rows, "step string, n_rows bigint")
    return FinetuneData(handles["train"], handles["validation"], handles["test"], vocab, counts)


# ------------------------------------------------------------ E4


@dataclass
class RatingSplits:
    train: DataFrame
    validation: DataFrame
    num_users: int
    num_items: int


def prepare_ratings(ratings: DataFrame, key, val_fraction: float = fx.RATING_VAL_FRACTION, seed: int = fx.SHUFFLE_SEED) -> RatingSplits:
    """E4 after reading: dense user/item index, normalised rating, permutation split."""
    uidx = A.dense_index(ratings, "user_id", "user_idx")
    iidx = A.dense_index(ratings, "item_id", "item_idx")
    # catalog sizes = index sizes (the indexes are materialised, counting them is cheap)
    sizes = {"num_users": uidx.count(), "num_items": iidx.count()}
    indexed = A.apply_index(A.apply_index(ratings, uidx, "user_id", sizes["num_users"]), iidx, "item_id", sizes["num_items"])
    norm = stored(P.normalise(indexed, "rating", fx.RATING_MIN, fx.RATING_MAX, "rating_norm"))
    train, valid = X.permutation_split(norm, val_fraction, key=key, seed=seed)
    keep = ["user_idx", "item_idx", "rating_norm"]
    return RatingSplits(train.select(*keep), valid.select(*keep), int(sizes["num_users"]), int(sizes["num_items"]))


def load_ratings(spark: SparkSession, paths: list[str], val_fraction: float = fx.RATING_VAL_FRACTION, seed: int = fx.SHUFFLE_SEED, cache: SourceCache | None = None) -> RatingSplits:
    """E4: the cache, if one is named, filled from the first available TSV -> typed ratings -> ``prepare_ratings``."""
    load = lambda s: R.read_first_available(s, paths, R.read_ratings_tsv)
    df = load(spark) if cache is None else cache.read(spark, "ratings", load)
    return prepare_ratings(df, ["user_id", "item_id", "timestamp"], val_fraction, seed)


# ------------------------------------------------------------ E5


def coalesce_inputs(df: DataFrame, vocab: TX.Vocab | None, key: str, max_length: int = 512,
                    carry: list[str] | None = None) -> DataFrame:
    """M7: rows with ids keep them (labels default to ids); text rows are tokenised;
    rows with neither are skipped.  ``carry`` columns are kept."""
    cols = set(df.columns)
    carry = carry or []
    if "input_ids" in cols:
        labels = F.coalesce(F.col("labels"), F.col("input_ids")) if "labels" in cols else F.col("input_ids")
        return df.select(key, "input_ids", labels.alias("labels"), *carry)
    if "text" in cols and vocab is not None:
        tok = TX.tokenise(df, vocab, max_length, key=key).select(key, "input_ids", "labels")
        return tok.join(df.select(key, *carry), key, "inner") if carry else tok
    none = F.lit(None).cast("array<bigint>")
    return df.where(F.lit(False)).select(key, none.alias("input_ids"), none.alias("labels"), *carry)


def evaluate_lm(test: DataFrame, lm: LM.NgramLM, key: str, num_samples: int = 100, vocab: TX.Vocab | None = None,
                generated_len: str | None = None, model_name: str = "ngram", checkpoint_path: str = "") -> DataFrame:
    """E5: first ``num_samples`` rows by ``key``; perplexity per row, generation score
    for rows longer than 20 tokens, summary.

    Text generation itself is not run: ``generated_len`` names a column with
    the generated length; without it the reference continuation (the second
    half of the row) is scored.
    """
    extra = [generated_len] if generated_len else []
    rows = coalesce_inputs(X.head(test, num_samples, key), vocab, key, carry=extra)
    ppl = LM.perplexity(rows, lm, key, tokens_col="labels")
    n = F.size("input_ids")
    gen = F.col(generated_len) if generated_len else (n - F.size(M.prompt_half("input_ids")))
    scored = rows.select(key, "input_ids", *extra).where(n > fx.GENERATION_MIN_TOKENS).select(key, M.generation_score(gen).alias("generation_score"))
    summary = MT.eval_summary(ppl.join(scored, key, "left"))
    return summary.select(
        "*", F.lit(model_name).alias("model_name"), F.lit(checkpoint_path).alias("checkpoint_path"), F.lit("cpu").alias("device")
    )


# ------------------------------------------------------------ E6


def load_text_splits(spark: SparkSession, root: str, vocab: TX.Vocab, key: str, text: str = "sentence", label: str = "label",
                     max_length: int = fx.PADDED_LENGTH, fraction: float = fx.SENTENCE_SAMPLE_FRACTION, seed: int = fx.SENTENCE_SEED) -> dict[str, DataFrame]:
    """E6: named splits, a 1 % seeded sample of each (before tokenising), padded tokens."""
    splits = R.load_splits(spark, root, lambda df: X.sample_fraction(df, fraction, key, seed))
    return {name: TX.tokenise_padded(df, vocab, max_length, key=key, text_col=text, carry=[label]) for name, df in splits.items()}


# ------------------------------------------------------------ E7 .. E11


def _push(spark, items):
    return S.push_all(spark, [S.PushItem(n, p, a) for n, p, a in items])


def tabular_mlp_job(spark: SparkSession, df: DataFrame, columns: str, target: tuple[str, str], key, out_root: str,
                    steps: int = 30, project: str = "housing", run_id: str = "run-0") -> tuple[DataFrame, DataFrame]:
    """E7: prep -> cast -> MLP fit -> save model -> export splits -> push results."""
    prep = preprocess(spark, columns, feature_prep(df, columns, target, key, out_root), out_root)
    cols = P.parse_columns(columns)
    train, valid = prep.train.load(spark), prep.validation.load(spark)
    model = MLP.fit_mlp(train, cols[:-1], cols[-1], steps=steps)
    both = X.split_column({"train": train, "validation": valid})
    scored = MLP.score_mlp(both, model, keep=["split", cols[-1]])
    metrics = MT.mse(scored, cols[-1], "prediction", by=["split"])
    model_path = f"{out_root}/model/{run_id}"
    return metrics, _push(spark, [
        ("model", "mlp", lambda: S.save_mlp(spark, model, model_path)),
        ("datasets", "parquet", lambda: S.export_splits(both, out_root, project, S.run_id_of(model_path))),
    ])


def tabular_gbt_job(spark: SparkSession, df: DataFrame, columns: str, target: tuple[str, str], key, out_root: str,
                    params: B.BoostParams = B.BoostParams(), project: str = "housing", run_id: str = "run-0") -> tuple[DataFrame, DataFrame]:
    """E8: prep -> cast -> drop extras -> label last -> boosted trees -> report -> push."""
    prep = preprocess(spark, columns, feature_prep(df, columns, target, key, out_root), out_root)
    train = P.drop_if_present(prep.train.load(spark))
    valid = P.drop_if_present(prep.validation.load(spark))
    feats, label = P.infer_label(train)
    model = B.fit_boosted(train, valid, feats, label, params)
    model_dir = f"{out_root}/model/{run_id}"
    B.save_boosted(spark, model, f"{model_dir}/checkpoint")
    rounds = B.round_rows(model, spark)
    final = rounds.orderBy(F.col("round").desc()).limit(1).select(F.lit("validation_rmse").alias("metric"), F.col("validation_rmse").alias("value"))
    report = S.write_report(spark, "Boosted-tree regression", MT.round_metrics(final), f"{out_root}/report/{run_id}")
    both = X.split_column({"train": train, "validation": valid})
    push = _push(spark, [
        ("model", "boosted-trees", lambda: f"{model_dir}/checkpoint"),  # the folder, as it can be loaded
        ("report", "json", lambda: f"{out_root}/report/{run_id}"),
        ("datasets", "parquet", lambda: S.export_splits(both, out_root, project, S.run_id_of(model_dir))),
    ])
    return report, push


def sentence_classifier_job(spark: SparkSession, splits: dict[str, DataFrame], key: str, text: str, label: str,
                            out_root: str, padded: dict[str, DataFrame] | None = None,
                            num_features: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """E9: classifier trained by epochs on train, each published as a checkpoint, the best on
    validation kept, MCC per split, contract check of the padded inputs (E6), push."""
    store = CheckpointStore(f"{out_root}/checkpoints")
    model, history = TE.fit_text_epochs(splits["train"], splits["validation"], key, text, label, TE.EpochParams(num_features=num_features), store)
    best = MT.best_run(history, "eval_loss", "min").collect()[0]["epoch"]
    rows = []
    for name, df in splits.items():
        pred = model.score(df, [key, label]).withColumn("argmax", M.argmax("logits"))
        rows.append(MT.mcc(pred, label, "argmax").withColumn("split", F.lit(name)))
    metrics = rows[0]
    for r in rows[1:]:
        metrics = metrics.unionByName(r)
    items = [("model", "text-epochs", lambda: store.steps(spark).where(F.col("step") == best).collect()[0]["path"])]
    if padded is not None:
        contract = [P.ColumnSpec(c, T.LongType(), 128) for c in ("input_ids", "attention_mask", "token_type_ids")]
        violations = P.check_contract(padded["validation"], contract).count()
        items.append(("contract", "schema", lambda: f"{violations} violations"))
    return metrics, _push(spark, items)


def instruction_eval_job(spark: SparkSession, dataset_name: str, sources: dict, key: str, out_root: str,
                         max_length: int = 512, sample_size: int = 10000, num_samples: int = 100,
                         orders: tuple[int, ...] = (1, 2)) -> tuple[DataFrame, DataFrame]:
    """E10: prepare the data (E3), fit n-gram LMs on train, keep the one with the lowest
    validation loss (``best_run`` over candidates, as the best checkpoint), evaluate it on test (E5)."""
    data = prepare_finetune_dataset(spark, dataset_name, sources, key, out_root, max_length, sample_size)
    train, valid = data.train.load(spark), data.validation.load(spark)
    models, rows = {}, []
    for n in orders:
        lm = LM.fit_ngram_lm(train, key, tokens_col="input_ids", n=n)
        models[n] = lm
        val = LM.perplexity(valid, lm, key, tokens_col="labels").agg(F.avg(F.log("perplexity")).alias("l")).collect()[0]["l"]
        rows.append((n, float("inf") if val is None else float(val)))
    history = spark.createDataFrame(rows, "epoch int, val_loss double")  # "epoch" = candidate order
    best = MT.best_run(history, "val_loss", "min").collect()[0]["epoch"]
    summary = evaluate_lm(data.test.load(spark), models[best], key, num_samples, data.vocab,
                          model_name=f"{best}-gram", checkpoint_path=f"{out_root}/finetune")
    return data.counts, summary


def recommender_job(splits: RatingSplits, params: RM.RatingParams = RM.RatingParams()) -> tuple[DataFrame, RM.RatingModel]:
    """E11: embeddings and head on train; MSE per split over all of its rows, and the model."""
    model = RM.fit_ratings(splits.train, params)
    scored = model.score(X.split_column({"train": splits.train, "validation": splits.validation}), ["split", "rating_norm"])
    return MT.mse(scored, "rating_norm", "prediction", by=["split"]), model
