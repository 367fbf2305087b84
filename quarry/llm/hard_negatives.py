"""Hard negatives by inner product, with coordinate pruning in length buckets (LEMP).

Vectors are integers, ``floor(scale * c)``, so scores are exact.  Rows lie in buckets of
like length: a class of lengths (a factor of ``GROWTH`` wide, so their number is bounded), of
one remainder of labels, dealt by a hash into parts of about ``BUCKET_CELLS`` numbers.  In
the task a bucket holds, for each coordinate, its vectors' normalised values in order.  For
an anchor and the least score it still looks for, ``t`` is the cosine that the bucket's
longest vector needs to reach it; a vector with that cosine has at each coordinate a value
within a range around the anchor's own (``cos(a + b) <= value <= cos(a - b)``, ``cos a`` being
the anchor's value and ``cos b = t``).  The ranges of the anchor's ``FOCUS`` largest
coordinates are found in the sorted lists, the narrowest gives the candidates, the others
cut them down, and what is left is scored exactly.  Buckets too short for an anchor never
meet it.

Two rounds: each anchor's positives, from the buckets of its label, the last of the best of
a first bucket bounding the search in all others; then the negatives from the others,
where the least allowed score is the bound.  Every anchor is held against every bucket
that its bound leaves, in blocks; a task holds one bucket and one block of anchors.

Defined cases: rows with a null id, a null label, a null or empty vector, a null or
non-finite component, another than the most frequent length (of equals, the larger), or a
squared integer length of 2^62 or more (whose scores no long holds) take no part; of rows
that repeat an id the least (label, vector) counts; ties go to the smaller id; anchors
without positives, and positives without negatives, give no rows; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

#: Numbers in a bucket's vectors and in a block's anchors, and anchors that are scored at a time.
BUCKET_CELLS, ANCHOR_CELLS, TOGETHER = 1 << 20, 1 << 19, 128
GROWTH = 1.1
#: Remainders of labels that have buckets of their own.
LABELS = 16
FOCUS = 5
SLACK = 1e-9


@dataclass(frozen=True)
class Bounds:
    """Which negatives count: ``low * positive <= of * negative <= high * positive``."""

    low: int = 80
    high: int = 100
    of: int = 100

    def range(self, positive: int) -> tuple[int, int]:
        """The least and the largest score allowed."""
        return -(-self.low * positive // self.of), self.high * positive // self.of


@dataclass(frozen=True)
class Kind:
    """The buckets of one class of lengths and one remainder of labels."""

    length: int
    rest: int
    parts: int
    longest: float
    one_label: bool


def usable(rows: DataFrame, label: Column, scale: int = 256) -> tuple[DataFrame, int]:
    """``vec_id, label, x, norm2`` of the rows that take part, and the vectors' length."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(float(1 << 40)), F.lit(False)) & ~F.isnan(c))
    kept = rows.where(F.col("vec_id").isNotNull() & label.isNotNull() & v.isNotNull() & good & (F.size(v) > 0))
    sizes = kept.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    whole = kept.where(F.size("embedding") == d).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(v, lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))
    square = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    whole = whole.withColumn("norm2", square).where(F.col("norm2") < F.lit(float(1 << 62)))
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "x", "norm2")).alias("r")).select("vec_id", "r.*"), d


def buckets(rows: DataFrame, bucket_rows: int) -> tuple[DataFrame, list[Kind]]:
    """``rows`` with ``class, rest``, and the kinds of buckets: as few as there are classes of lengths."""
    step = 2 * math.log(GROWTH)
    classed = rows.withColumn("class", F.when(F.col("norm2") < 1, -1).otherwise(F.floor(F.log(F.greatest(F.col("norm2"), F.lit(1.0))) / step)).cast("int"))
    classed = classed.withColumn("rest", F.pmod("label", F.lit(LABELS)).cast("int"))
    kinds = classed.groupBy("class", "rest").agg(F.count("*").alias("n"), F.max("norm2").alias("longest"), F.min("label").alias("low"), F.max("label").alias("high")).orderBy("class", "rest").collect()
    return classed, [Kind(r["class"], r["rest"], -(-r["n"] // bucket_rows), math.sqrt(r["longest"]), r["low"] == r["high"]) for r in kinds]


def _name() -> Column:
    return F.concat_ws(",", "class", "rest")


def _part(kinds: list[Kind]) -> Column:
    """The part of its kind that a row lies in."""
    names, parts = [F.lit(f"{k.length},{k.rest}") for k in kinds], [F.lit(k.parts) for k in kinds]
    return F.pmod(F.xxhash64("vec_id"), F.element_at(F.map_from_arrays(F.array(*names), F.array(*parts)), _name())).cast("int")


class Bucket:
    """Vectors of like length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.double = self.x.astype(np.float64)
        lengths = np.sqrt((self.double**2).sum(1))
        self.longest = float(lengths.max())
        self.unit = np.ascontiguousarray((self.double / np.maximum(lengths, 1e-300)[:, None]).T)  # [coordinate, row]
        self.order = np.argsort(self.unit, axis=1, kind="stable")
        self.lists = np.take_along_axis(self.unit, self.order, axis=1)

    def candidates(self, anchor: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` with the anchor; None for all."""
        if not least > 0 or not length or not self.longest:
            return None
        t = least / (length * self.longest) - SLACK
        if t > 1:
            return np.empty(0, np.int64)
        b, unit = math.acos(max(0.0, t)), anchor / length
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            a = math.acos(min(1.0, max(-1.0, unit[f])))
            low, high = math.cos(min(math.pi, a + b)) - SLACK, math.cos(max(0.0, a - b)) + SLACK
            begin, end = np.searchsorted(self.lists[f], low, "left"), np.searchsorted(self.lists[f], high, "right")
            ranges.append((end - begin, f, begin, end, low, high))
        ranges.sort(key=lambda r: r[0])
        size, f, begin, end, _, _ = ranges[0]
        if size == len(self.ids):
            return None  # no range leaves anything out
        rows = self.order[f, begin:end]
        for size, f, _, _, low, high in ranges[1:]:
            if size < len(self.ids):
                value = self.unit[f][rows]
                rows = rows[(value >= low) & (value <= high)]
        return np.sort(rows)

    def scores(self, anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each anchor, rows (by rising id) and their exact scores, those below ``least`` left out."""
        # by Cauchy-Schwarz no partial sum leaves the range in which doubles are exact
        exact = self.longest * lengths.max(initial=0.0) * (1 + SLACK) < 1 << 53
        x, q = (self.double, anchors.astype(np.float64)) if exact else (self.x, anchors)
        found = [self.candidates(*one) for one in zip(anchors, lengths, least)]
        wide = [i for i, rows in enumerate(found) if rows is None or 4 * len(rows) > len(self.ids)]
        together = dict(zip(wide, q[wide] @ x.T)) if wide else {}
        for i, rows in enumerate(found):
            if rows is None:
                score = together[i]
            else:
                score = together[i][rows] if i in together else x[rows] @ q[i]
            kept = np.flatnonzero(score >= least[i])
            yield kept if rows is None else rows[kept], score[kept].astype(np.int64)


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), np.stack(rows["x"].to_list()).astype(np.int64)


def _blocks(anchors: pd.DataFrame) -> Iterator[tuple]:
    for begin in range(0, len(anchors), TOGETHER):
        part = anchors.iloc[begin : begin + TOGETHER]
        yield part, *_arrays(part), np.sqrt(part["norm2"].to_numpy(np.float64))


def _below(least) -> np.ndarray:
    """Doubles not above the given numbers, which may have been rounded up."""
    return np.nextafter(np.asarray(least, np.float64), -np.inf)


def _positives(k: int):
    """The ``k`` best of a bucket with the anchor's label, for each anchor."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            bucket = Bucket(*_arrays(right))
            for part, ids, labels, x, lengths in _blocks(left):
                for i, (rows, score) in enumerate(bucket.scores(x, lengths, _below(part["least"]))):
                    own = (bucket.labels[rows] == labels[i]) & (bucket.ids[rows] != ids[i])
                    rows, score = rows[own], score[own]
                    if len(rows) > k:  # with all that tie with the last
                        best = score >= -np.partition(-score, k - 1)[k - 1]
                        rows, score = rows[best], score[best]
                    best = np.argsort(-score, kind="stable")[:k]
                    out += zip([int(ids[i])] * len(best), bucket.ids[rows[best]].tolist(), score[best].tolist())
        return pd.DataFrame(out, columns=["anchor_id", "vec_id", "score"]).astype("int64")

    return run


def _negatives(k: int, bounds: Bounds):
    """The ``k`` best of a bucket for each anchor and positive score, of another label and within the bounds."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            bucket = Bucket(*_arrays(right))
            for part, ids, labels, x, lengths in _blocks(left):
                wanted = [sorted(int(p) for p in w) for w in part["wanted"]]
                least = _below([bounds.range(w[0])[0] for w in wanted])
                for i, (rows, score) in enumerate(bucket.scores(x, lengths, least)):
                    own = bucket.labels[rows] != labels[i]
                    rows, score = rows[own], score[own]
                    order = np.argsort(-score, kind="stable")
                    rows, falling = rows[order], -score[order]
                    for positive in wanted[i]:
                        low, high = bounds.range(positive)
                        begin, end = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
                        for r in range(begin, min(begin + k, end)):
                            out.append((int(ids[i]), positive, int(bucket.ids[rows[r]]), -int(falling[r])))
        return pd.DataFrame(out, columns=["anchor_id", "positive_score", "vec_id", "score"]).astype("int64")

    return run


def _meet(anchors: DataFrame, rows: DataFrame, kinds: list[Kind], which: Callable[[Column], Column], meet, schema: str, blocks: int) -> DataFrame:
    """Anchors (with ``least``) and the buckets that can reach it, of those whose kind ``which`` allows."""
    table = F.array(*[F.struct(F.lit(k.length).alias("class"), F.lit(k.rest).alias("rest"), F.lit(k.parts).alias("parts"), F.lit(k.longest).alias("longest"), F.lit(k.one_label).alias("one")) for k in kinds])
    left = anchors.select("*", F.explode(F.filter(table, which)).alias("kind"))
    left = left.where(F.sqrt("norm2") * F.col("kind.longest") * (1 + SLACK) >= F.col("least"))
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.col("kind.parts") - 1)).alias("part"), F.col("kind.class").alias("class"), F.col("kind.rest").alias("rest")).drop("kind")
    left = left.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    right = rows.select("vec_id", "label", "x", "class", "rest", _part(kinds).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    by = ["class", "rest", "part", "block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, schema)


FOUND = "anchor_id long, vec_id long, score long"
NEGATIVES = "anchor_id long, positive_score long, vec_id long, score long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _best(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", turn).where(F.col("rank") <= k)


def mine(embeddings: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, scale: int = 256, bounds: Bounds = Bounds()) -> DataFrame:
    """Columns of ``MINED``; ``is_anchor``: a condition on ``vec_id``; ``label``: the label, if it isn't
    the column of that name."""
    if bounds.low < 0 or bounds.of <= 0 or bounds.high <= bounds.low:
        raise ValueError("bounds must be a range of non-negative shares")
    spark = embeddings.sparkSession
    own, d = usable(embeddings, F.col("label") if label is None else label, scale)
    rows, kinds = buckets(saved(own), max(64, BUCKET_CELLS // max(1, d)))
    if not kinds:
        return spark.createDataFrame([], MINED)
    anchors = saved(rows.where(is_anchor).select("vec_id", "label", "x", "norm2", F.col("rest").alias("own")))
    total = anchors.count()
    if not total:
        return spark.createDataFrame([], MINED)
    blocks = -(-total // max(64, ANCHOR_CELLS // d))

    # positives: the first bucket of the longest of the anchor's label bounds the search in all
    first = [replace(k, parts=1) for k in {k.rest: k for k in sorted(kinds, key=lambda k: k.length)}.values()]
    is_first = F.array_contains(F.array(*[F.lit(f"{k.length},{k.rest}") for k in first]), _name()) & (_part(kinds) == 0)
    of_label = lambda k: k["rest"] == F.col("own")
    unbounded = anchors.withColumn("least", F.lit(float("-inf")))
    seeds = _meet(unbounded, rows.where(is_first), first, of_label, _positives(positives), FOUND, blocks)
    floor = seeds.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.min("score").cast("double").alias("floor"), F.count("*").alias("n")).where(F.col("n") == positives)
    bounded = saved(anchors.join(floor, "vec_id", "left").withColumn("least", F.coalesce("floor", F.lit(float("-inf")))).drop("floor", "n"))
    found = _meet(bounded, rows, kinds, of_label, _positives(positives), FOUND, blocks)
    # a score below zero allows no negative: its share would lie above it
    chosen = saved(_best(found, positives, ["anchor_id"]).where("score >= 0").select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # negatives: of every other label, from the least score that any positive allows
    wanted = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("wanted"))  # ``positives`` at most
    asking = anchors.join(wanted, "vec_id").withColumn("least", F.array_min("wanted") * (bounds.low / bounds.of * (1 - SLACK)) - SLACK)
    near = _meet(asking, rows, kinds, lambda k: ~(k["one"] & (k["rest"] == F.col("own"))), _negatives(negatives, bounds), NEGATIVES, blocks)
    named = chosen.join(_best(near, negatives, ["anchor_id", "positive_score"]), ["anchor_id", "positive_score"])
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
