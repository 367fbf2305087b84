"""Rating model: user and item embeddings, a two-layer head, trained block by block.

Users and items are dealt into ``B`` blocks each, which cut the ratings into ``B x B`` cells.
In round ``s`` of an epoch the cells ``(b, b + s mod B)`` are trained side by side: no two of
them share a user or an item, so each task takes stochastic gradient steps on its own
vectors without locks, and after ``B`` rounds every rating was used once.  The dense head is
trained in each cell from the same start and averaged after the round, weighted by ratings.

A user or item that holds ``1 / (2 B)`` of all ratings or more would fill its blocks' cells.
There are at most ``2 B`` such on a side; they are treated like the head: every cell has a
copy, copies are averaged by the ratings that touched them, and their ratings are dealt
evenly over all cells.

The vectors are a table that each round writes to the checkpoint folder, as single-precision
numbers (a task computes in double precision); the driver holds the head and the shared
vectors.  An epoch moves that table ``B`` times, so a cell takes as many ratings as a task holds well.  ``B`` follows from the number of ratings, users and items,
the order of ratings from a hash, so a fit doesn't depend on partitioning or retries.

Rows are scored by a broadcast of the vectors if those of either side take ``BROADCAST_BYTES`` at
most.  Otherwise they are dealt into cells as well: each gets the vectors of its users and items
once, then its rows as a stream, so no row carries vectors through a shuffle.

Defined cases: ratings with a NULL user, item or value, or a NaN value, teach nothing; repeated
ratings count each; a user or item unknown from training scores with a zero vector; no
ratings to fit raise ``ValueError``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixed import RECOMMENDER_EPOCHS, RECOMMENDER_HIDDEN, RECOMMENDER_RANK
from quarry.operators.layout import materialize

#: Ratings of a cell, and users or items of a block, that a task takes on.
CELL_ROWS, BLOCK_ENTITIES = 1 << 19, 1 << 19
#: Vectors of a side that are broadcast: the driver holds them several times while it sends them.
BROADCAST_BYTES = 32 << 20
#: Users or items of a block whose rows are scored; smaller than for training, as a cell's rows are sorted.
SCORED_ENTITIES = 1 << 18
INIT_STD = 0.01
RATING, USER, ITEM, SHARED_USER, SHARED_ITEM, HEAD = range(6)
TRAINED = "kind int, idx long, vec array<float>, n double, common array<double>"
_TRAINED_ARROW = pa.schema([("kind", pa.int32()), ("idx", pa.int64()), ("vec", pa.list_(pa.float32())), ("n", pa.float64()), ("common", pa.list_(pa.float64()))])


@dataclass(frozen=True)
class RatingParams:
    rank: int = RECOMMENDER_RANK
    hidden: int = RECOMMENDER_HIDDEN
    epochs: int = RECOMMENDER_EPOCHS
    rate: float = 0.05
    batch: int = 256
    blocks: int | None = None  # from the sizes, if not given
    seed: int = 42

    def head(self) -> list[np.ndarray]:
        rng = np.random.default_rng(self.seed)
        sizes = [2 * self.rank, self.hidden, self.hidden, 1]
        out = []
        for a, b in zip(sizes, sizes[1:]):
            out += [rng.uniform(-1, 1, (a, b)) / math.sqrt(a), np.zeros(b)]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(x: np.ndarray, head: list[np.ndarray]) -> list[np.ndarray]:
    """The head's inputs and the outputs of its layers; the last are ratings in [0, 1]."""
    acts = [x]
    for i in range(0, len(head), 2):
        z = acts[-1] @ head[i] + head[i + 1]
        acts.append(np.maximum(z, 0) if i + 2 < len(head) else _sigmoid(z))
    return acts


def gradients(x: np.ndarray, y: np.ndarray, head: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Of the mean squared error by the head, and of each row's squared error by its inputs."""
    acts = forward(x, head)
    p = acts[-1][:, 0]
    delta = (2 * (p - y) * p * (1 - p))[:, None]
    grads: list[np.ndarray] = [np.empty(0)] * len(head)
    for i in reversed(range(0, len(head), 2)):
        grads[i], grads[i + 1] = acts[i // 2].T @ delta / len(y), delta.mean(0)
        delta = delta @ head[i].T
        if i:
            delta = delta * (acts[i // 2] > 0)
    return grads, delta


class _Side:
    """Vectors of one side in a cell: its block's, then the shared ones; each with the running
    sum of squared gradients that sets its steps."""

    def __init__(self, idx: np.ndarray, state: np.ndarray, shared: np.ndarray, shared_state: np.ndarray):
        self.own = len(idx)
        names = np.concatenate([idx, shared])
        self.order = np.argsort(names, kind="stable")
        self.names, self.state = names[self.order], np.concatenate([state, shared_state])
        self.all_names = names
        self.seen = np.zeros(len(names))

    def rows(self, idx: np.ndarray) -> np.ndarray:
        return self.order[np.searchsorted(self.names, idx)]

    def step(self, at: np.ndarray, grads: np.ndarray, rate: float) -> None:
        order = np.argsort(at, kind="stable")
        rows, first, times = np.unique(at[order], return_index=True, return_counts=True)
        total = np.add.reduceat(grads[order], first, axis=0)
        k = grads.shape[1]
        self.state[rows, k:] += total * total
        self.state[rows, :k] -= rate * total / np.sqrt(self.state[rows, k:] + 1e-8)
        self.seen[rows] += times


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays])


def _unflat(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for a in like:
        out.append(flat[at : at + a.size].reshape(a.shape))
        at += a.size
    return out


@dataclass
class Shared:
    """What every cell has a copy of: vectors of frequent users and items, and the head; each with
    its sums of squared gradients behind it."""

    users: np.ndarray
    user_state: np.ndarray
    items: np.ndarray
    item_state: np.ndarray
    head: np.ndarray


def _vectors(rows: pa.Table, width: int) -> np.ndarray:
    flat = pc.list_flatten(rows["vec"]).to_numpy()
    return flat.astype(float).reshape(rows.num_rows, width)


def _trainer(params: RatingParams, shared: Shared):
    k, like = params.rank, params.head()

    def train(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        part = lambda kind: table.filter(pa.array(kinds == kind))
        ratings = part(RATING).select(["turn_order", "idx", "other", "value"])
        ratings = ratings.sort_by([(c, "ascending") for c in ratings.column_names])
        sides = []
        for kind, names, state in ((USER, shared.users, shared.user_state), (ITEM, shared.items, shared.item_state)):
            own = part(kind).sort_by("idx")
            sides.append(_Side(own["idx"].to_numpy(), _vectors(own, 2 * k), names, state))
        users, items = sides
        n = ratings.num_rows
        size = sum(a.size for a in like)
        head, squares = _unflat(shared.head[:size].copy(), like), _unflat(shared.head[size:].copy(), like)
        if n:
            u, i, y = users.rows(ratings["idx"].to_numpy()), items.rows(ratings["other"].to_numpy()), ratings["value"].to_numpy()
            for at in range(0, n, params.batch):
                a, b, t = u[at : at + params.batch], i[at : at + params.batch], y[at : at + params.batch]
                grads, by_input = gradients(np.concatenate([users.state[a, :k], items.state[b, :k]], axis=1), t, head)
                for w, s, g in zip(head, squares, grads):
                    s += g * g
                    w -= 0.2 * params.rate * g / np.sqrt(s + 1e-8)
                users.step(a, by_input[:, :k], params.rate)
                items.step(b, by_input[:, k:], params.rate)
        out = []
        for side, kind in ((users, USER), (items, ITEM)):
            flat = side.state[: side.own].astype(np.float32).ravel()
            vec = pa.ListArray.from_arrays(pa.array(np.arange(side.own + 1) * 2 * k, pa.int32()), pa.array(flat))
            out.append(pa.table([pa.array(np.full(side.own, kind, np.int32)), pa.array(side.all_names[: side.own]), vec, pa.array(side.seen[: side.own]), pa.nulls(side.own, pa.list_(pa.float64()))], schema=_TRAINED_ARROW))
        common = [(kind, name, side.state[row], seen) for side, kind in ((users, SHARED_USER), (items, SHARED_ITEM))
                  for row, (name, seen) in enumerate(zip(side.all_names.tolist(), side.seen.tolist())) if row >= side.own and seen]
        if n:
            common.append((HEAD, 0, np.concatenate([_flat(head), _flat(squares)]), float(n)))
        out.append(pa.table([[r[0] for r in common], [r[1] for r in common], pa.nulls(len(common), pa.list_(pa.float32())), [r[3] for r in common], [r[2].tolist() for r in common]], schema=_TRAINED_ARROW))
        return pa.concat_tables(out)

    return train


def no_vec(kind: str) -> Column:
    """Of rows without a vector: an empty list, as Spark's Arrow writer goes through a batch's NULL lists anew for every row."""
    return F.array().cast(f"array<{kind}>")


def _initial(idx: Column, rank: int, seed: int) -> Column:
    """Normal numbers by a hash of the index, then zeros for the sums of squares."""
    uniform = lambda i, k: (F.pmod(F.xxhash64(idx, i, F.lit(seed + k)), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))
    normal = F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), lambda i: F.lit(INIT_STD) * F.sqrt(F.lit(-2.0) * F.log(uniform(i, 0))) * F.cos(F.lit(2 * math.pi) * uniform(i, 1)))
    return F.concat(normal, F.array_repeat(F.lit(0.0), rank))


class _Vectors:
    """Vectors of one side of a cell, as they arrive; looked up once all are there."""

    def __init__(self, rank: int):
        self.rank, self.parts, self.names = rank, [], None

    def add(self, rows: pa.RecordBatch) -> None:
        exact = pc.list_value_length(rows.column("vec")).to_numpy() > 0
        vec = np.empty((rows.num_rows, self.rank), np.float32 if exact.all() else np.float64)
        vec[exact] = rows.column("vec").flatten().to_numpy().reshape(-1, self.rank)
        if not exact.all():
            vec[~exact] = rows.column("wide").flatten().to_numpy().reshape(-1, self.rank)
        self.parts.append((rows.column("idx").to_numpy().copy(), vec))  # a view would keep the whole batch

    def of(self, idx: pa.Array) -> np.ndarray:
        if self.names is None:
            names, vec = (np.concatenate([p[i] for p in self.parts]) if self.parts else none for i, none in enumerate((np.empty(0, np.int64), np.empty((0, self.rank)))))
            order = np.argsort(names, kind="stable")
            self.names, self.vec, self.parts = names[order], vec[order], []
        out = np.zeros((len(idx), self.rank))
        if len(self.names):
            wanted = pc.fill_null(idx, 0).to_numpy()
            at = np.minimum(np.searchsorted(self.names, wanted), len(self.names) - 1)
            here = (self.names[at] == wanted) & pc.is_valid(idx).to_numpy(zero_copy_only=False)
            out[here] = self.vec[at[here]]
        return out


@dataclass
class RatingModel:
    """``users``/``items``: ``idx, vec``; ``head``: weights and offsets layer by layer."""

    users: DataFrame
    items: DataFrame
    head: list[np.ndarray]
    rank: int
    n_users: int
    n_items: int
    hot_users: list[int] = field(default_factory=list)
    hot_items: list[int] = field(default_factory=list)
    user: str = "user_idx"
    item: str = "item_idx"

    @property
    def small(self) -> bool:
        """Whether the vectors of either side may be broadcast."""
        return max(self.n_users, self.n_items) * (8 * self.rank + 32) <= BROADCAST_BYTES

    def with_vectors(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_u`` and ``_i``, zeros where a user or item is unknown."""
        if not self.small:
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_u", "_i"))])
            return self._in_cells(df, df.columns, lambda u, i: [lists(u), lists(i)], schema)
        zeros = F.array_repeat(F.lit(0.0), self.rank)
        out = df
        for column, table, name in ((self.user, self.users, "_u"), (self.item, self.items, "_i")):
            out = out.join(F.broadcast(table.select(F.col("idx").alias(column), F.col("vec").alias(name))), column, "left")
            out = out.withColumn(name, F.coalesce(name, zeros))
        return out

    def map_vectors(self, df: DataFrame, keep: list[str], finish: Callable[[np.ndarray, np.ndarray], list[pa.Array]], schema: T.StructType) -> DataFrame:
        """``keep`` columns of every row and what ``finish`` makes of the vectors of a batch's users and items,
        a matrix each, zeros where one is unknown."""
        if not self.small:
            return self._in_cells(df, keep, finish, schema)
        own, rank = self.with_vectors(df).select(*keep, "_u", "_i"), self.rank

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    u, i = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, rank) for c in ("_u", "_i"))
                    yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *finish(u, i)], names=schema.fieldNames())

        return own.mapInArrow(run, schema)

    def _in_cells(self, df: DataFrame, keep: list[str], finish: Callable[[np.ndarray, np.ndarray], list[pa.Array]], schema: T.StructType) -> DataFrame:
        """``keep`` columns and what ``finish`` makes of the vectors of rows' users and items, cell by cell.
        The vectors of users go to the cells of their block with every block of items, and the
        other way round; rows of a frequent user or item are dealt over all blocks, as its vector is."""
        ub, ib = (-(-n // SCORED_ENTITIES) or 1 for n in (self.n_users, self.n_items))
        while ub * ib < df.sparkSession.sparkContext.defaultParallelism:
            ub, ib = (ub + 1, ib) if self.n_users * ib >= self.n_items * ub else (ub, ib + 1)
        home = lambda idx, blocks: F.pmod(F.xxhash64(idx, F.lit(0)), F.lit(blocks))

        def block(idx: Column, hot: list[int], blocks: int, salt: Column) -> Column:
            return F.when(idx.isin(hot), F.pmod(F.xxhash64(salt, F.lit(1)), F.lit(blocks))).otherwise(home(idx, blocks)) if hot else home(idx, blocks)

        u, i = F.col(self.user).cast("long"), F.col(self.item).cast("long")
        cell = block(u, self.hot_users, ub, i) * ib + block(i, self.hot_items, ib, u)
        rows = df.select(cell.alias("cell"), F.lit(RATING).alias("kind"), u.alias("idx"), i.alias("other"), no_vec("float").alias("vec"), no_vec("double").alias("wide"), *[F.col(c).alias(f"c{j}") for j, c in enumerate(keep)])
        single = F.col("vec").cast("array<float>")
        exact = single.cast("array<double>") == F.col("vec")
        for kind, table, hot, own, others in ((USER, self.users, self.hot_users, ub, ib), (ITEM, self.items, self.hot_items, ib, ub)):
            blocks = F.array(home(F.col("idx"), own))
            if hot:
                blocks = F.when(F.col("idx").isin(hot), F.sequence(F.lit(0).cast("long"), F.lit(own - 1).cast("long"))).otherwise(blocks)
            own_rows = table.select("idx", F.when(exact, single).otherwise(no_vec("float")).alias("vec"), F.when(exact, no_vec("double")).otherwise(F.col("vec")).alias("wide"), F.explode(blocks).alias("own"))
            own_rows = own_rows.withColumn("across", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
            cell = F.col("own") * ib + F.col("across") if kind == USER else F.col("across") * ib + F.col("own")
            rows = rows.unionByName(own_rows.select(cell.alias("cell"), F.lit(kind).alias("kind"), "idx", "vec", "wide"), allowMissingColumns=True)
        rank, n_keep = self.rank, len(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, sides = None, {}
            for batch in batches:
                cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
                ends = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
                for start, end in pairwise([0, *ends.tolist(), batch.num_rows] if batch.num_rows else []):
                    part = batch.slice(start, end - start)
                    if cells[start] != at:
                        at, sides = cells[start], {USER: _Vectors(rank), ITEM: _Vectors(rank)}
                    if kinds[start] != RATING:
                        sides[kinds[start]].add(part)
                        continue
                    made = finish(sides[USER].of(part.column("idx")), sides[ITEM].of(part.column("other")))
                    yield pa.RecordBatch.from_arrays([*(part.column(f"c{j}") for j in range(n_keep)), *made], names=schema.fieldNames())

        # a cell's vectors come before its rows
        return rows.repartition("cell").sortWithinPartitions("cell", F.col("kind").desc()).mapInArrow(run, schema)

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns + ``prediction double`` in [0, 1], for every row (the ``Scorer`` protocol)."""
        head = self.head
        predict = lambda u, i: [pa.array(forward(np.concatenate([u, i], axis=1), head)[-1][:, 0])]
        return self.map_vectors(df, keep, predict, T.StructType([*df.select(*keep).schema.fields, T.StructField("prediction", T.DoubleType())]))


def fit_ratings(ratings: DataFrame, params: RatingParams = RatingParams(), user: str = "user_idx", item: str = "item_idx", rating: str = "rating_norm") -> RatingModel:
    spark = ratings.sparkSession
    value = F.col(rating).cast("double")
    own = materialize(ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull() & value.isNotNull() & ~F.isnan(value))
                      .select(F.col(user).cast("long").alias("u"), F.col(item).cast("long").alias("i"), value.alias("value")))
    n = own.count()
    if not n:
        raise ValueError("no ratings to fit")
    users = materialize(own.groupBy(F.col("u").alias("idx")).agg(F.count("*").alias("n")))
    items = materialize(own.groupBy(F.col("i").alias("idx")).agg(F.count("*").alias("n")))
    n_users, n_items = users.count(), items.count()
    blocks = params.blocks or max(math.isqrt(-(-n // CELL_ROWS) - 1) + 1, -(-n_users // BLOCK_ENTITIES), -(-n_items // BLOCK_ENTITIES))
    frequent = lambda table: [r["idx"] for r in table.where(F.col("n") * (2 * blocks) >= n).orderBy("idx").collect()] if blocks > 1 else []
    hot_users, hot_items = frequent(users), frequent(items)  # 2 * blocks of each at most

    def block(idx: Column, hot: list[int], salt: Column) -> Column:
        home = F.pmod(F.xxhash64(idx, F.lit(params.seed)), F.lit(blocks))
        return (F.when(idx.isin(hot), F.pmod(F.xxhash64(salt, idx, F.lit(params.seed + 1)), F.lit(blocks))).otherwise(home) if hot else home).cast("int")

    ub, ib = block(F.col("u"), hot_users, F.struct("i", "value")), block(F.col("i"), hot_items, F.struct("u", "value"))
    cells = own.select("u", "i", "value", ub.alias("cell"), F.pmod(ib - ub, F.lit(blocks)).alias("turn"))
    cells = materialize(cells.repartition(F.col("turn"), F.col("cell")))
    vectors = [t.where(~F.col("idx").isin(hot)) if hot else t for t, hot in ((users, hot_users), (items, hot_items))]
    state = None
    for kind, table in ((USER, vectors[0]), (ITEM, vectors[1])):
        part = table.select(F.lit(kind).alias("kind"), "idx", _initial(F.col("idx"), params.rank, params.seed + 10 * kind).cast("array<float>").alias("vec"))
        state = part if state is None else state.unionByName(part)
    state = materialize(state)

    def start(idx: list[int], kind: int) -> np.ndarray:
        if not idx:
            return np.zeros((0, 2 * params.rank))
        table = spark.createDataFrame([(x,) for x in idx], "idx long")
        rows = {r["idx"]: r["vec"] for r in table.select("idx", _initial(F.col("idx"), params.rank, params.seed + 10 * kind).alias("vec")).collect()}
        return np.array([rows[x] for x in idx])

    head = _flat(params.head())
    shared = Shared(np.array(hot_users, np.int64), start(hot_users, USER), np.array(hot_items, np.int64), start(hot_items, ITEM), np.concatenate([head, np.zeros_like(head)]))
    for epoch in range(params.epochs):
        for turn in range(blocks):
            order = F.xxhash64("u", "i", "value", F.lit(params.seed + 100 + epoch))
            rows = cells.where(F.col("turn") == turn).select("cell", F.lit(RATING).alias("kind"), F.col("u").alias("idx"), F.col("i").alias("other"), "value", no_vec("float").alias("vec"), order.alias("turn_order"))
            home = F.pmod(F.xxhash64("idx", F.lit(params.seed)), F.lit(blocks))
            cell = F.when(F.col("kind") == USER, home).otherwise(F.pmod(home - turn, F.lit(blocks))).cast("int")
            own_rows = state.select(cell.alias("cell"), "kind", "idx", F.lit(0).cast("long").alias("other"), F.lit(0.0).alias("value"), "vec", F.lit(0).cast("long").alias("turn_order"))
            trained = materialize(rows.unionByName(own_rows).groupBy("cell").applyInArrow(_trainer(params, shared), TRAINED))
            state = trained.where(F.col("kind").isin(USER, ITEM)).select("kind", "idx", "vec")
            mean = Summarizer.mean(array_to_vector("common"), F.col("n"))
            averaged = trained.where(~F.col("kind").isin(USER, ITEM)).groupBy("kind", "idx").agg(vector_to_array(mean).alias("vec")).collect()
            got = {(r["kind"], r["idx"]): np.array(r["vec"]) for r in averaged}
            shared = Shared(shared.users, np.array([got.get((SHARED_USER, x), s) for x, s in zip(hot_users, shared.user_state)]).reshape(-1, 2 * params.rank),
                            shared.items, np.array([got.get((SHARED_ITEM, x), s) for x, s in zip(hot_items, shared.item_state)]).reshape(-1, 2 * params.rank),
                            got.get((HEAD, 0), shared.head))
    tables = []
    for kind, hot, hot_state in ((USER, hot_users, shared.user_state), (ITEM, hot_items, shared.item_state)):
        table = state.where(F.col("kind") == kind).select("idx", F.slice("vec", 1, params.rank).cast("array<double>").alias("vec"))
        if hot:
            table = table.unionByName(spark.createDataFrame([(x, s[: params.rank].tolist()) for x, s in zip(hot, hot_state)], "idx long, vec array<double>"))
        tables.append(table)
    like = params.head()
    return RatingModel(*tables, _unflat(shared.head[: sum(a.size for a in like)], like), params.rank, n_users, n_items, hot_users, hot_items, user, item)


def save_ratings_model(model: RatingModel, path: str) -> str:
    spark = model.users.sparkSession
    model.users.write.mode("overwrite").parquet(f"{path}/users")
    model.items.write.mode("overwrite").parquet(f"{path}/items")
    row = ([a.ravel().tolist() for a in model.head], [list(a.shape) for a in model.head], model.rank, model.n_users, model.n_items, model.hot_users, model.hot_items, model.user, model.item)
    schema = "head array<array<double>>, shapes array<array<int>>, rank int, n_users long, n_items long, hot_users array<long>, hot_items array<long>, user string, item string"
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/head")
    return path


def load_ratings_model(spark: SparkSession, path: str) -> RatingModel:
    r = spark.read.parquet(f"{path}/head").first()
    head = [np.array(a).reshape(s) for a, s in zip(r["head"], r["shapes"])]
    return RatingModel(spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"), head, r["rank"], r["n_users"], r["n_items"], list(r["hot_users"]), list(r["hot_items"]), r["user"], r["item"])
