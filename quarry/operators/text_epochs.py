"""Text classifier trained epoch by epoch: sparse logistic regression that goes on from its state.

Rows become counts of hashed words once; weighted by rarity (``ln((n + 1) / (rows with it + 1))``) and
scaled to length one they are what a row weighs in with.  An epoch reads each row once, in ``steps``
slices dealt by a hash of the key: for a slice every task adds up the gradient of the words
it meets under the broadcast weights, Spark sums those sparse vectors, and the driver
takes one Adagrad step (weights and sums of squared gradients, ``num_features`` numbers each).
After an epoch the loss on the validation rows is taken and, with a store, weights and
sums are published as a checkpoint.  A fit that finds published epochs goes on after the last
one and, the slices being fixed, ends with the weights of a fit that was never stopped.

Defined cases: rows with a NULL label teach nothing, NULL or empty texts are texts without
words; repeated rows count each; a validation set without rows has an infinite loss.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import words
from quarry.operators.batches import cut
from quarry.operators.keys import seeded_hash
from quarry.operators.layout import materialize, spread
from quarry.sources.checkpoints import CheckpointStore

EPSILON = 1e-8
#: Words whose hashes a task keeps, before it starts anew.
CACHE_ENTRIES = 50_000
#: Rows and bytes of a batch that become Python objects at once.
PART_ROWS, PART_BYTES = 256, 1 << 18


@dataclass(frozen=True)
class EpochParams:
    epochs: int = 3
    steps: int = 4
    rate: float = 0.2
    num_features: int = 1 << 18
    seed: int = 1


@dataclass
class TextModel:
    """``weights`` and ``squares``: one per hashed word, the offset last; ``idf``: one per hashed word."""

    weights: np.ndarray
    squares: np.ndarray
    idf: np.ndarray
    text: str = "text"
    label: str = "label"

    @property
    def num_features(self) -> int:
        return len(self.idf)

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` + ``logits array<float>`` (2) + ``prediction int`` (the ``Scorer`` protocol)."""
        own = df.select(*keep, F.coalesce(words(self.text), F.array().cast("array<string>")).alias("_words"))
        shared = df.sparkSession.sparkContext.broadcast(self)  # num_features numbers
        k = len(keep)

        def run(batches):
            model, hashed = shared.value, _Hashed(len(shared.value.idf))
            for batch in _parts(batches):
                if batch.num_rows:
                    z = np.array([model.margin(*hashed(ws)) for ws in batch.column(k).to_pylist()])
                    logits = pa.array([[-v / 2, v / 2] for v in z.tolist()], pa.list_(pa.float32()))
                    yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(k)], logits, pa.array((z > 0).astype(np.int32))], names=[*keep, "logits", "prediction"])

        fields = [*own.schema.fields[:k], T.StructField("logits", T.ArrayType(T.FloatType())), T.StructField("prediction", T.IntegerType())]
        return own.mapInArrow(run, T.StructType(fields))

    def inputs(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf[ids]
        length = math.sqrt(x @ x)
        return x / length if length else x

    def margin(self, ids: np.ndarray, counts: np.ndarray) -> float:
        return float(self.weights[ids] @ self.inputs(ids, counts) + self.weights[-1])

    def table(self, spark: SparkSession) -> DataFrame:
        """The state as rows ``idx, w, s, idf``, those of unused words left out."""
        used = np.flatnonzero((self.squares != 0) | (np.append(self.idf, 0.0) != 0) | (np.arange(len(self.weights)) == len(self.idf)))
        idf = np.append(self.idf, 0.0)
        return spark.createDataFrame([(int(i), float(self.weights[i]), float(self.squares[i]), float(idf[i])) for i in used], "idx int, w double, s double, idf double")


def model_of(table: DataFrame, num_features: int, text: str, label: str) -> TextModel:
    rows = table.toPandas()  # num_features rows at most
    out = [np.zeros(num_features + 1) for _ in range(3)]
    for column, into in zip(("w", "s", "idf"), out):
        into[rows["idx"].to_numpy()] = rows[column].to_numpy()
    return TextModel(out[0], out[1], out[2][:-1], text, label)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` in small pieces: lists of words and counts take up many times their Arrow size as Python objects."""
    for batch in batches:
        yield from cut(batch, PART_ROWS, PART_BYTES)


class _Hashed:
    """Words to the sorted numbers of their hashes, and how often each stands there."""

    def __init__(self, num_features: int):
        self.n, self.known = num_features, {}

    def __call__(self, ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts: Counter = Counter()
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        for w, c in Counter(ws).items():
            at = self.known.get(w)
            if at is None:
                at = self.known[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % self.n
            counts[at] += c
        ids = sorted(counts)
        return np.array(ids, np.int64), np.array([counts[i] for i in ids], float)


def word_counts(df: DataFrame, key: str, text: str, label: str, num_features: int, steps: int, seed: int) -> DataFrame:
    """``slice int, y double, ids array<int>, counts array<double>``."""
    own = spread(df.where(F.col(label).isNotNull()).select(key, text, label), key)
    own = own.select((seeded_hash(key, seed) % steps).cast("int").alias("slice"), F.col(label).cast("double").alias("y"), F.coalesce(words(text), F.array().cast("array<string>")).alias("words"))

    def run(batches):
        hashed = _Hashed(num_features)
        for batch in _parts(batches):
            if batch.num_rows:
                each = [hashed(ws) for ws in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([i for i, _ in each], pa.list_(pa.int32())), pa.array([c for _, c in each], pa.list_(pa.float64()))], names=["slice", "y", "ids", "counts"])

    return own.mapInArrow(run, "slice int, y double, ids array<int>, counts array<double>")


def gradient(rows: DataFrame, model: TextModel) -> tuple[np.ndarray, int]:
    """Sum over rows of the log loss's gradient by the weights, and the rows' number."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, total, n = shared.value, np.zeros(len(shared.value.weights)), 0
        for batch in _parts(batches):
            for y, ids, counts in zip(*[batch.column(c).to_pylist() for c in ("y", "ids", "counts")]):
                at = np.array(ids, np.int64)
                x = m.inputs(at, np.array(counts))
                off = 0.5 * (1 + math.tanh(0.5 * (m.weights[at] @ x + m.weights[-1]))) - y
                total[at] += off * x
                total[-1] += off
                n += 1
        used = np.flatnonzero(total)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(total[used], float(n)))], names=["idx", "g"])

    summed = rows.select("y", "ids", "counts").mapInArrow(run, "idx int, g double").groupBy("idx").agg(F.sum("g").alias("g")).toPandas()  # num_features rows
    shared.unpersist()
    out, n = np.zeros(len(model.weights)), 0
    for idx, g in zip(summed["idx"].tolist(), summed["g"].tolist()):
        if idx < 0:
            n = int(g)
        else:
            out[idx] = g
    return out, n


def mean_loss(rows: DataFrame, model: TextModel) -> float:
    """Mean log loss, in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total, n = 0.0, 0
        for batch in _parts(batches):
            for y, ids, counts in zip(*[batch.column(c).to_pylist() for c in ("y", "ids", "counts")]):
                z = shared.value.margin(np.array(ids, np.int64), np.array(counts))
                total += max(z, 0.0) + math.log1p(math.exp(-abs(z))) - y * z
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"loss": [total], "n": [n]})

    r = rows.select("y", "ids", "counts").mapInArrow(run, "loss double, n long").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).first()
    return r["loss"] / r["n"] if r["n"] else math.inf


def fit_text_epochs(train: DataFrame, valid: DataFrame, key: str, text: str = "text", label: str = "label",
                    params: EpochParams = EpochParams(), store: CheckpointStore | None = None) -> tuple[TextModel, DataFrame]:
    """The model of the epoch with the lowest validation loss (of equals, the earliest), and ``epoch, eval_loss``
    rows.  With a ``store``, epochs already published there are not trained again."""
    spark = train.sparkSession
    if store is not None:
        store = CheckpointStore(store.root, json.dumps(asdict(params) | {"epochs": None, "key": key, "text": text, "label": label}, sort_keys=True), "min")
    rows = materialize(word_counts(train, key, text, label, params.num_features, params.steps, params.seed))
    held = materialize(word_counts(valid, key, text, label, params.num_features, 1, params.seed))
    found = store.last(spark) if store else None
    if found:
        model, done = model_of(store.load(spark, found, "state"), params.num_features, text, label), found["step"]
        history = {r["step"]: r["metric"] for r in store.steps(spark).where(F.col("step") <= params.epochs).collect()}
    else:
        n = rows.count()
        seen = rows.select(F.explode("ids").alias("idx")).groupBy("idx").agg(F.count("*").alias("n")).toPandas()  # num_features rows
        idf = np.zeros(params.num_features)
        idf[seen["idx"].to_numpy(int)] = np.log((n + 1) / (seen["n"].to_numpy(float) + 1))
        model, done, history = TextModel(np.zeros(params.num_features + 1), np.zeros(params.num_features + 1), idf, text, label), 0, {}
    best = (math.inf, model)
    for epoch in range(done + 1, params.epochs + 1):
        for turn in range(params.steps):
            g, n = gradient(rows.where(F.col("slice") == turn), model)
            if n:
                g = g / n
                squares = model.squares + g * g
                model = TextModel(model.weights - params.rate * g / np.sqrt(squares + EPSILON), squares, model.idf, text, label)
        history[epoch] = mean_loss(held, model)
        if store:
            store.publish(spark, epoch, {"state": model.table(spark)}, history[epoch])
            store.prune(spark)
        if history[epoch] < best[0] or epoch == 1:
            best = (history[epoch], model)
    losses = spark.createDataFrame(sorted(history.items()), "epoch int, eval_loss double")
    if store and store.best(spark):
        return model_of(store.load(spark, store.best(spark), "state"), params.num_features, text, label), losses
    return best[1], losses
