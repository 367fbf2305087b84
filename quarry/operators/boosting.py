"""Gradient-boosted regression trees from exact gradient histograms.

Features are cut at exact quantiles of the training rows (at most ``bins`` intervals
each), found by radix descent: a pass counts, per feature, the values by their next 16
bits and only the cells that hold a quantile are looked into further, so a handful of
small counting passes replace a sort.  Training rows are then kept as interval numbers.

Each level of each tree is one pass over them: tasks add up gradient and row count per
(node, feature, interval) of the tree's sampled columns, Spark sums those tables, and the best
split of each node is found in SQL over at most ``bins`` rows per (node, feature).  The
split's gain is the usual regularised one with an L1 soft threshold on gradient sums:
``s(GL, HL) + s(GR, HR) - s(G, H)``, halved, with ``s(G, H) = max(|G| - l1, 0)^2 / (H + l2)``.
Missing values go to the side that gains more.

Gradients are added up as fixed-point integers (``GRADIENT_BITS`` bits below the largest
label), so trees don't depend on partitioning, order or retries.  The driver holds the
trees, the cuts and the best splits of a level, all bounded by the parameters.

Defined cases: NULL or NaN features are missing values, NULL or NaN labels raise
``ValueError``, as does an empty training set; ties go to the first column, then the lowest
interval; a feature without two values is never split.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.fixed import GBT_FEATURE_FRACTION, GBT_L1, GBT_MAX_DEPTH, GBT_ROUNDS, GBT_STEP_SIZE
from quarry.operators.layout import materialize, spread

GRADIENT_BITS = 30
#: Gains up to this are rounding.
LEAST_GAIN = 1e-6
DIGIT = 16  # bits that a counting pass looks at


@dataclass(frozen=True)
class BoostParams:
    """10 rounds, depth 5, rate 0.1, 30 % of the columns per tree, L1 10, L2 1."""

    rounds: int = GBT_ROUNDS
    max_depth: int = GBT_MAX_DEPTH
    step_size: float = GBT_STEP_SIZE
    feature_fraction: float = GBT_FEATURE_FRACTION
    l1: float = GBT_L1
    l2: float = 1.0
    min_gain: float = 0.0
    min_rows: int = 1
    bins: int = 256
    seed: int = 1

    def columns_of(self, tree: int, features: list[str]) -> list[int]:
        """The columns that a tree may split: drawn anew for each, by a seeded hash."""
        rank = lambda i: hashlib.md5(f"{features[i]}|{tree}|{self.seed}".encode()).hexdigest()
        return sorted(sorted(range(len(features)), key=rank)[: max(1, int(len(features) * self.feature_fraction))])


@dataclass(frozen=True)
class Split:
    feature: int
    bin: int  # rows of this interval and below go left
    threshold: float  # the same in values
    missing_left: bool
    gain: float


@dataclass
class Tree:
    """Nodes are numbered from the root, 1; the children of ``n`` are ``2n`` and ``2n + 1``."""

    columns: list[int]
    splits: dict[int, Split] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)  # values as added to the prediction


@dataclass
class BoostedTrees:
    features: list[str]
    label: str
    base: float
    trees: list[Tree]
    valid_rmse: list[float] = field(default_factory=list)  # after each round

    def stages(self) -> list[Column]:
        """The prediction after each round, as expressions on the feature columns."""
        x = [F.col(f"`{f}`").cast("double") for f in self.features]
        total, out = F.lit(self.base), []
        for tree in self.trees:
            total = total + _tree_column(tree, x, 1)
            out.append(total)
        return out

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns + ``prediction double`` (the ``Scorer`` protocol)."""
        return df.select(*keep, (self.stages() or [F.lit(self.base)])[-1].alias("prediction"))


def _tree_column(tree: Tree, x: list[Column], node: int) -> Column:
    split = tree.splits.get(node)
    if split is None:
        return F.lit(tree.leaves[node])
    value = x[split.feature]
    missing = value.isNull() | F.isnan(value)
    left = missing | (value <= split.threshold) if split.missing_left else ~missing & (value <= split.threshold)
    return F.when(left, _tree_column(tree, x, 2 * node)).otherwise(_tree_column(tree, x, 2 * node + 1))


# ----------------------------------------------------------- exact quantiles


def sortable(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers in the same order (-0.0 as 0.0)."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def unsortable(keys: np.ndarray) -> np.ndarray:
    bits = np.where(keys >> np.uint64(63) == 1, keys & np.uint64((1 << 63) - 1), ~keys)
    return bits.view(np.float64)


def _matrix(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)])


def quantile_cuts(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Per feature, the distinct values at ranks ``ceil(j * n / bins)``, ``0 < j < bins``, of its ``n``
    values that aren't missing."""
    k = len(features)
    own = df.select(*[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    cuts: list[set[int]] = [set() for _ in features]
    # cells to look into: per feature the leading bits seen so far, rows below them, rows of the feature
    open_cells: list[dict[int, int]] = [{0: 0} for _ in features]
    for level in range(64 // DIGIT):
        looked = [np.array(sorted(cells), np.uint64) for cells in open_cells]
        shift = np.uint64(64 - DIGIT * (level + 1))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list[dict[int, list[int]]] = [{} for _ in range(k)]
            for batch in batches:
                for i in range(k):
                    x = batch.column(i).to_numpy(zero_copy_only=False)
                    keys = sortable(x[~np.isnan(x)])
                    if level:
                        head = keys >> (shift + np.uint64(DIGIT))
                        keys = keys[np.isin(head, looked[i])]
                    keys.sort()
                    cells, first, n = np.unique(keys >> shift, return_index=True, return_counts=True)
                    last = first + n - 1
                    for cell, a, b, m in zip(cells.tolist(), keys[first].tolist(), keys[last].tolist(), n.tolist()):
                        got = found[i].get(cell)
                        if got is None:
                            found[i][cell] = [m, a, b]
                        else:
                            got[0], got[1], got[2] = got[0] + m, min(got[1], a), max(got[2], b)
            rows = [(i, cell, *v) for i in range(k) for cell, v in found[i].items()]
            if rows:
                f, cell, n, low, high = zip(*rows)
                # keys as decimals: they fill 64 bits without a sign
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array([str(c) for c in cell]), pa.array(n, pa.int64()), pa.array([str(c) for c in low]), pa.array([str(c) for c in high])], names=["f", "cell", "n", "low", "high"])

        key = lambda c: F.col(c).cast("decimal(20,0)")
        counted = own.mapInArrow(count, "f int, cell string, n long, low string, high string")
        cells = counted.groupBy("f", key("cell").alias("cell")).agg(F.sum("n").alias("n"), F.min(key("low")).alias("low"), F.max(key("high")).alias("high"))
        if level == 0:
            upto = Window.partitionBy("f").orderBy("cell")  # 2^16 rows a feature at most
            cells = cells.withColumn("total", F.sum("n").over(Window.partitionBy("f")))
            cells = cells.withColumn("below", F.sum("n").over(upto) - F.col("n"))
        else:
            heads = [(i, str(head), below, totals[i]) for i in range(k) for head, below in open_cells[i].items()]
            known = df.sparkSession.createDataFrame(heads, "g int, head string, before long, total long").select("g", key("head").alias("head"), "before", "total")
            cells = cells.withColumn("parent", F.floor(F.col("cell") / (1 << DIGIT)).cast("decimal(20,0)"))
            cells = cells.join(F.broadcast(known), (F.col("f") == F.col("g")) & (F.col("parent") == F.col("head")))  # bins rows a feature
            upto = Window.partitionBy("f", "parent").orderBy("cell")
            cells = cells.withColumn("below", F.col("before") + F.sum("n").over(upto) - F.col("n"))
        ranks = lambda c: F.expr(f"({c}) * {bins} div total")  # how many of the ranks lie there or below
        wanted = cells.where(ranks("below + n") > ranks("below"))
        # the last rank is the largest value, not a cut, unless another rank falls there as well
        wanted = wanted.where((ranks("below + n") < bins) | (ranks("below + n") - ranks("below") > 1))
        if level == 0:
            totals = {}
        open_cells = [{} for _ in features]
        for r in wanted.select("f", "cell", "below", "total", "low", "high").collect():  # bins rows a feature at most
            totals[r["f"]] = r["total"]
            if r["low"] == r["high"] or level == 64 // DIGIT - 1:
                cuts[r["f"]].add(int(r["low"]))
            else:
                open_cells[r["f"]][int(r["cell"])] = r["below"]
        if not any(open_cells):
            break
    return [unsortable(np.array(sorted(c), np.uint64)) for c in cuts]


# ---------------------------------------------------------------------- fit


def _binned(df: DataFrame, features: list[str], label: str, cuts: list[np.ndarray]) -> DataFrame:
    """``bins array<smallint>`` (-1: missing) and ``y``."""
    k = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, k)
                at = np.column_stack([np.searchsorted(c, x[:, i] + 0.0, "left") for i, c in enumerate(cuts)])
                at = np.where(np.isnan(x), -1, at).astype(np.int16)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, at.ravel())
                yield pa.RecordBatch.from_arrays([lists, batch.column(k)], names=["bins", "y"])

    own = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate([*features, label])])
    return own.mapInArrow(run, "bins array<smallint>, y double")


class _Walker:
    """Rows of interval numbers to nodes and predictions, in numpy."""

    def __init__(self, base: float, trees: list[Tree], depth: int):
        self.base, self.depth = base, depth
        self.tables = [self._table(t) for t in trees]

    def _table(self, tree: Tree) -> tuple:
        size = 1 << (self.depth + 1)
        feature, at, inner = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
        left, value = np.zeros(size, bool), np.zeros(size)
        for n, s in tree.splits.items():
            feature[n], at[n], inner[n], left[n] = s.feature, s.bin, True, s.missing_left
        for n, v in tree.leaves.items():
            value[n] = v
        return feature, at, inner, left, value

    def nodes(self, tree: int, bins: np.ndarray) -> np.ndarray:
        feature, at, inner, left, _ = self.tables[tree]
        rows, node = np.arange(len(bins)), np.ones(len(bins), np.int64)
        for _ in range(self.depth):
            b = bins[rows, feature[node]]
            right = np.where(b < 0, ~left[node], b > at[node])
            node = np.where(inner[node], 2 * node + right, node)
        return node

    def predict(self, bins: np.ndarray, trees: int) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for t in range(trees):
            out = out + self.tables[t][4][self.nodes(t, bins)]
        return out


def _histograms(binned: DataFrame, walker: _Walker, tree: int, columns: list[int], active: list[int], scale: float, width: int) -> DataFrame:
    """``node, feature, bin, g, h``: fixed-point gradient sums and row counts of the active nodes."""
    slot = np.full(1 << (walker.depth + 1), -1)
    slot[active] = np.arange(len(active))
    cells = (len(active), len(columns), width + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h = np.zeros(cells, np.int64).ravel(), np.zeros(cells, np.int64).ravel()
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            own = slot[walker.nodes(tree, bins)]
            rows = own >= 0
            bins, own = bins[rows], own[rows]
            grad = np.floor((walker.predict(bins, tree) - y[rows]) * scale + 0.5).astype(np.int64)
            for j, c in enumerate(columns):
                at = (own * len(columns) + j) * (width + 1) + bins[:, c] + 1
                np.add.at(g, at, grad)
                h += np.bincount(at, minlength=len(h))
        at = np.flatnonzero(h)
        if len(at):
            node, j, b = np.unravel_index(at, cells)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(active)[node], pa.int64()), pa.array(np.array(columns)[j], pa.int32()), pa.array(b - 1, pa.int32()), pa.array(g[at]), pa.array(h[at])], names=["node", "feature", "bin", "g", "h"])

    parts = binned.mapInArrow(run, "node long, feature int, bin int, g long, h long")
    return parts.groupBy("node", "feature", "bin").agg(F.sum(F.col("g").cast("decimal(38,0)")).alias("g"), F.sum("h").alias("h"))


def best_splits(histograms: DataFrame, params: BoostParams, scale: float) -> DataFrame:
    """Per node: ``g, h`` of all its rows and, where a split gains, ``feature, bin, missing_left, gain``
    and the left side's ``gl, hl``."""
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    real = lambda c: c.cast("double") / F.lit(scale)

    def s(g: Column, h: Column) -> Column:
        t = F.greatest(F.abs(g) - F.lit(float(params.l1)), F.lit(0.0))
        return t * t / (h.cast("double") + F.lit(float(params.l2)))

    each = histograms.select(
        "node", "feature", "bin", F.sum("g").over(whole).alias("g"), F.sum("h").over(whole).alias("h"),
        F.sum("g").over(upto).alias("gu"), F.sum("h").over(upto).alias("hu"),
        F.sum(F.when(F.col("bin") < 0, F.col("g")).otherwise(F.lit(0))).over(whole).alias("gm"),
        F.sum(F.when(F.col("bin") < 0, F.col("h")).otherwise(F.lit(0))).over(whole).alias("hm"))
    sides = F.array(F.struct(F.lit(True).alias("missing_left"), F.col("gu").alias("gl"), F.col("hu").alias("hl")),
                    F.struct(F.lit(False).alias("missing_left"), (F.col("gu") - F.col("gm")).alias("gl"), (F.col("hu") - F.col("hm")).alias("hl")))
    tried = each.select("node", "feature", "bin", "g", "h", F.explode(sides).alias("s")).select("node", "feature", "bin", "g", "h", "s.*")
    gain = F.lit(0.5) * (s(real(F.col("gl")), F.col("hl")) + s(real(F.col("g") - F.col("gl")), F.col("h") - F.col("hl")) - s(real(F.col("g")), F.col("h")))
    rows = max(1, params.min_rows)
    allowed = (F.col("bin") >= 0) & (F.col("hl") >= rows) & (F.col("h") - F.col("hl") >= rows) & (F.col("gain") > max(params.min_gain, LEAST_GAIN))
    tried = tried.withColumn("gain", gain)
    best = F.max(F.when(allowed, F.struct("gain", -F.col("feature"), -F.col("bin"), "missing_left", "gl", "hl", "feature", "bin"))).alias("b")
    return tried.groupBy("node").agg(F.first("g").alias("g"), F.first("h").alias("h"), best).select("node", "g", "h", "b.gain", "b.missing_left", "b.gl", "b.hl", "b.feature", "b.bin")


def _label_stats(df: DataFrame, label: str) -> tuple[int, float]:
    y = F.col(f"`{label}`").cast("double")
    r = df.agg(F.count("*").alias("n"), F.count_if(y.isNull() | F.isnan(y)).alias("bad"), F.max(F.abs(y)).alias("m")).first()
    if not r["n"]:
        raise ValueError("no rows to fit")
    if r["bad"]:
        raise ValueError(f"{r['bad']} labels are NULL or NaN")
    return r["n"], r["m"]


def fit_boosted(train: DataFrame, valid: DataFrame | None, features: list[str], label: str, params: BoostParams = BoostParams()) -> BoostedTrees:
    """Fit ``params.rounds`` trees; the error on ``valid`` is taken after each round."""
    n, largest = _label_stats(train, label)
    scale = 2.0 ** (GRADIENT_BITS - math.frexp(largest)[1])
    train = spread(train.select(*features, label))
    cuts = quantile_cuts(train, features, params.bins)
    binned = materialize(_binned(train, features, label, cuts))
    total = binned.agg(F.sum(F.floor(F.col("y") * F.lit(scale) + F.lit(0.5)).cast("decimal(38,0)")).alias("s")).first()["s"]
    model = BoostedTrees(features, label, float(total) / scale / n, [])
    width = max((len(c) for c in cuts), default=0) + 1
    for t in range(params.rounds):
        tree = Tree(params.columns_of(t, features))
        model.trees.append(tree)
        sums: dict[int, tuple[int, int]] = {}  # nodes to be split or made leaves
        active, depth = [1], 0
        while active and depth < params.max_depth:
            walker = _Walker(model.base, model.trees, params.max_depth)
            found = best_splits(_histograms(binned, walker, t, tree.columns, active, scale, width), params, scale).collect()
            active = []
            for r in sorted(found, key=lambda r: r["node"]):
                node, g, h = r["node"], int(r["g"]), r["h"]
                sums[node] = g, h
                if r["gain"] is None:
                    continue
                f, b = r["feature"], r["bin"]
                tree.splits[node] = Split(f, b, float(cuts[f][b]) if b < len(cuts[f]) else math.inf, r["missing_left"], r["gain"])
                sums[2 * node], sums[2 * node + 1] = (int(r["gl"]), r["hl"]), (g - int(r["gl"]), h - r["hl"])
                active += [2 * node, 2 * node + 1]
            depth += 1
        for node, (g, h) in sums.items():
            if node not in tree.splits:
                g = g / scale
                tree.leaves[node] = -math.copysign(max(abs(g) - params.l1, 0.0), g) / (h + params.l2) * params.step_size
    if valid is not None:
        model.valid_rmse = round_errors(model, valid)
    return model


def round_errors(model: BoostedTrees, df: DataFrame) -> list[float]:
    """RMSE after each round, in one pass."""
    y = F.col(f"`{model.label}`").cast("double")
    got = df.agg(*[F.sqrt(F.avg(F.pow(p - y, F.lit(2.0)))).alias(f"r{i}") for i, p in enumerate(model.stages())]).first()
    return [float("nan") if v is None else v for v in got]


def round_rows(model: BoostedTrees, spark: SparkSession) -> DataFrame:
    """``(round, validation_rmse)`` rows."""
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(model.valid_rmse)], "round int, validation_rmse double")


# ------------------------------------------------------------------ storage

NODES = "tree int, node int, feature int, bin int, threshold double, missing_left boolean, gain double, value double"


def save_boosted(spark: SparkSession, model: BoostedTrees, path: str) -> str:
    """One row per node, and one per model with names and base."""
    rows = [(t, n, s.feature, s.bin, s.threshold, s.missing_left, s.gain, None) for t, tree in enumerate(model.trees) for n, s in tree.splits.items()]
    rows += [(t, n, None, None, None, None, None, v) for t, tree in enumerate(model.trees) for n, v in tree.leaves.items()]
    spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    head = [(model.features, model.label, model.base, [t.columns for t in model.trees], model.valid_rmse)]
    spark.createDataFrame(head, "features array<string>, label string, base double, columns array<array<int>>, valid_rmse array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    return path


def load_boosted(spark: SparkSession, path: str) -> BoostedTrees:
    r = spark.read.parquet(f"{path}/model").first()
    model = BoostedTrees(list(r["features"]), r["label"], r["base"], [Tree(list(c)) for c in r["columns"]], list(r["valid_rmse"]))
    for row in spark.read.parquet(f"{path}/nodes").collect():  # bounded by rounds and depth
        tree = model.trees[row["tree"]]
        if row["feature"] is None:
            tree.leaves[row["node"]] = row["value"]
        else:
            tree.splits[row["node"]] = Split(row["feature"], row["bin"], row["threshold"], row["missing_left"], row["gain"])
    return model
