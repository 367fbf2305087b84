"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Each entry ``c`` becomes the integer ``floor(scale * c) + shift``.  The covariance is taken
over each distinct integer vector once.  A task shifts every dimension to start at zero,
cuts it into bit planes and packs each plane across the rows of a block into 64-bit
words; the sum of products of two dimensions is the sum over their planes ``p`` and ``q`` of
``2^(p+q)`` times the number of ones in ``plane_p AND plane_q``.  Spark adds up the blocks'
sums, so neither the order nor the partitioning of rows changes a digit.  The scatter is
centred in integers (``n * sum(xy) - sum(x) * sum(y)``) and only then made a double for
``eigh`` on the driver, which sees matrices of the vectors' length and nothing else.

Defined cases: rows whose vector is null, empty, holds a null or non-finite entry or an integer
of 2^40 or more, or doesn't have the most frequent length (of equals, the larger), take no
part; null ids are kept; repeated rows are each returned, and fitted once; components without
variance (eigenvalues below rounding error) can't be whitened and are left out, so there
may be fewer than asked for, or none; an empty table gives no rows; a deviation that no long
holds is null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

#: Rows whose planes are packed at a time: 256 words a plane.
BLOCK = 64 * 256
LARGEST = 1 << 40


def integers(vector: Column, scale: int = 256, shift: int = 0) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(shift))


def usable(rows: DataFrame, scale: int = 256, shift: int = 0) -> tuple[DataFrame, int]:
    """``vec_id, x`` of the rows that take part, and the vectors' length."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda c: F.coalesce(F.abs(c) * scale < F.lit(float(LARGEST - abs(shift))), F.lit(False)) & ~F.isnan(c))
    kept = rows.where(v.isNotNull() & good & (F.size(v) > 0))
    sizes = kept.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return kept.where(F.size("embedding") == d).select("vec_id", integers(F.col("embedding"), scale, shift).alias("x")), d


def matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)


def bit_planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words [plane, word]: the bits of each column of ``x - low``, low bits first, packed across rows."""
    y = (x - low).astype(np.uint64).T
    planes = np.concatenate([(y[a] >> np.arange(n, dtype=np.uint64)[:, None]) & np.uint64(1) for a, n in enumerate(bits)]).astype(np.uint8)
    packed = np.packbits(planes, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def sliced_products(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact sums of products [dimension, dimension] of the shifted columns, upper triangle."""
    d, start = len(bits), np.cumsum(bits) - bits
    place = np.arange(len(words)) - np.repeat(start, bits)  # the bit a plane stands for
    wide = int(2 * bits.max() + np.log2(words.shape[1] * 64) + 2) > 62
    out = np.zeros((d, d), object if wide else np.int64)
    for a in range(d):
        for p in range(start[a], start[a] + bits[a]):
            ones = np.bitwise_count(words[p] & words[start[a] :]).sum(axis=1, dtype=np.int64)
            weighted = ones.astype(out.dtype) << place[start[a] :].astype(out.dtype)
            out[a, a:] += np.add.reduceat(weighted, start[a:] - start[a]) << int(place[p])
    return out


@dataclass(frozen=True)
class Fit:
    n: int  # distinct vectors
    sums: list[int]  # per dimension
    scatter: list[list[int]]  # sums of products, centred and times n
    values: np.ndarray  # eigenvalues of the covariance, falling
    vectors: np.ndarray  # [dimension, component]

    @property
    def explained(self) -> np.ndarray:
        return self.values / (sum(self.scatter[a][a] for a in range(len(self.sums))) / self.n**2)


def extent(vectors: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of vectors, least and largest entry of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.full(d, np.iinfo(np.int64).max), np.full(d, np.iinfo(np.int64).min)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, "x", d)
                n, low, high = n + len(x), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, n)), pa.array(low), pa.array(high)], names=["a", "n", "low", "high"])

    parts = vectors.select("x").mapInArrow(run, "a int, n long, low long, high long")
    got = parts.groupBy("a").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("a").collect()  # d rows
    if not got:
        return 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
    return got[0]["n"], np.array([r["low"] for r in got]), np.array([r["high"] for r in got])


def scatter(vectors: DataFrame, d: int, low: np.ndarray, high: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums per dimension and sums of products, both of ``x - low``."""
    bits = np.maximum([int(h - l).bit_length() for h, l in zip(high, low)], 1)
    first = np.cumsum(bits) - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, held, rows = np.zeros((d, d), object), np.zeros(d, object), [], 0

        def add(x: np.ndarray) -> None:
            nonlocal products, sums
            words = bit_planes(x, low, bits)
            ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(object)
            place = (np.arange(len(words)) - np.repeat(first, bits)).astype(object)
            sums = sums + np.add.reduceat(ones << place, first)
            products = products + sliced_products(words, bits).astype(object)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(matrix(batch, "x", d))
            rows += batch.num_rows
            if rows >= BLOCK:
                x = np.concatenate(held)
                for at in range(0, rows - rows % BLOCK, BLOCK):
                    add(x[at : at + BLOCK])
                held, rows = [x[rows - rows % BLOCK :]], rows % BLOCK
        if rows:
            add(np.concatenate(held))
        if not sums.any():
            return  # products of nothing but zeros
        a, b = np.triu_indices(d)
        names = [*zip(a.tolist(), b.tolist()), *((i, -1) for i in range(d))]
        totals = [*products[a, b].tolist(), *sums.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in names], pa.int32()), pa.array([y for _, y in names], pa.int32()), pa.array([str(t) for t in totals])], names=["a", "b", "total"])

    parts = vectors.select("x").mapInArrow(run, "a int, b int, total string")
    added = parts.groupBy("a", "b").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("decimal(38,0)").alias("total"))
    products, sums = [[0] * d for _ in range(d)], [0] * d
    for r in added.collect():  # about d * d / 2 rows
        if r["b"] < 0:
            sums[r["a"]] = int(r["total"])
        else:
            products[r["a"]][r["b"]] = products[r["b"]][r["a"]] = int(r["total"])
    return sums, products


def fit(vectors: DataFrame, d: int, components: int = 4) -> Fit | None:
    """``vectors``: ``x``, each counted as it stands; None without any."""
    n, low, high = extent(vectors, d)
    if not n:
        return None
    shifted, products = scatter(vectors, d, low, high)
    centred = [[n * products[a][b] - shifted[a] * shifted[b] for b in range(d)] for a in range(d)]  # the shift falls out
    covariance = np.array([[v / n**2 for v in row] for row in centred])  # integer by integer, rounded once
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = [i for i in range(min(components, d)) if values[i] > d * np.finfo(float).eps * max(values[0], 0.0)]
    values, axes = values[kept], axes[:, kept]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), range(len(kept))] < 0, -1.0, 1.0)  # one sign for all rows
    return Fit(n, [s + n * int(l) for s, l in zip(shifted, low)], centred, values, axes)


WHITENED = "whitened array<double>, deviation decimal(38,0)"


def whiten(rows: DataFrame, model: Fit) -> DataFrame:
    """``rows`` (with ``x``) with ``whitened`` (one number a component) and ``deviation``, the exact
    sum over dimensions of ``(n * x - sum)^2``."""
    d = len(model.sums)
    axes = model.vectors / np.sqrt(model.values)
    sums, n = np.array(model.sums, object), model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "x", d)
            most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, model.sums))
            kind = np.int64 if d * most * most < 1 << 63 else object  # whichever holds all squares added up
            centred = n * x.astype(kind) - sums.astype(kind)
            deviation = (centred * centred).sum(axis=1)
            white = (centred.astype(np.float64) / n) @ axes
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * axes.shape[1], white.ravel())
            numbers = pa.array([str(v) for v in deviation.tolist()]).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, numbers], names=[*batch.schema.names, "whitened", "deviation"])

    own = rows.drop("whitened", "deviation")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    return own.mapInArrow(run, f"{fields}, {WHITENED}")


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` less the identity."""
    at = [F.element_at("whitened", i + 1) for i in range(components)]
    pairs = [F.abs(F.covar_pop(at[i], at[j]) - (1.0 if i == j else 0.0)) for i in range(components) for j in range(i, components)]
    return white.agg(F.array_max(F.array(*pairs)).alias("e")).first()["e"]


def whitened(embeddings: DataFrame, components: int = 4, scale: int = 256, shift: int = 0) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, one row for
    each row that takes part and component."""
    rows, d = usable(embeddings, scale, shift)
    schema = "vec_id {}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double".format(embeddings.schema["vec_id"].dataType.simpleString())
    vectors = saved(rows.select("x").distinct())
    model = fit(vectors, d, components)
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(whiten(vectors, model), len(model.values))
    each = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return each.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.element_at(explained, F.col("i") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
