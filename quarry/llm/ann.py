"""Nearest neighbours by largest inner product: multiprobe p-stable hashing.

Inner products are turned into distances by one more coordinate: ``x / M`` gets
``sqrt(1 - |x|^2 / M^2)`` (``M``: the largest norm), a query gets 0.  Each of ``tables``
tables cuts a few Gaussian projections into cells of ``WIDTH``.  A query visits, per
table, its own cell and perturbed ones in the order of estimated success (the sum of
squared distances to the cells' borders), and all found are scored exactly.

Every row is indexed.  Equal vectors are searched as one and named by their smallest ids,
as many as a result could hold, so a vector that very many rows share is one entry.
Cells that agree in their first projections form a group; a group's vectors and the
queries that probe one of its cells meet in one task, a large group in several.  Only
the number of probes is fitted, on a bounded sample of rows (``FIT_ROWS``) and queries
(``FIT_QUERIES``), to the wanted recall.  A query that found fewer than ``k`` is held
against all rows, in blocks.

Defined cases: rows with a null id, and vectors that are null, zero, hold a null or
non-finite component or don't have the most frequent length take no part; repeated rows
(id and vector) count once; ties go to the smaller id; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved, shuffle_partitions

WIDTH = 2.0
FIT_ROWS, FIT_QUERIES = 20_000, 100
#: Vectors of one group that meet in one task.
GROUP_ROWS = 20_000


@dataclass(frozen=True)
class Index:
    directions: np.ndarray  # [table, dimension + 1, projection]
    offsets: np.ndarray  # [table, projection]
    coarse: int  # projections that name a group
    norm: float
    probes: int

    def project(self, table: int, vectors: np.ndarray, query: bool) -> np.ndarray:
        if query:
            x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            last = np.zeros((len(x), 1))
        else:
            x = vectors / self.norm
            last = np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))
        return (np.concatenate([x, last], axis=1) @ self.directions[table] + self.offsets[table]) / WIDTH

    def probed(self, place: np.ndarray) -> np.ndarray:
        """Cells to visit for one query's projections, best first."""
        own = np.floor(place).astype(np.int64)
        inside = place - own
        cost = np.concatenate([inside, 1 - inside]) ** 2  # to the cell below, to the one above
        order = np.argsort(cost, kind="stable")
        cost, m = cost[order], len(own)
        cells, heap = [own], [(cost[0], (0,))]
        while heap and len(cells) < self.probes:
            total, chosen = heapq.heappop(heap)
            last = chosen[-1]
            axes = [order[i] % m for i in chosen]
            if len(set(axes)) == len(axes):  # not both ways along one projection
                cell = own.copy()
                for i, axis in zip(chosen, axes):
                    cell[axis] += -1 if order[i] < m else 1
                cells.append(cell)
            if last + 1 < 2 * m:
                heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
                heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
        return np.array(cells)


def _key(cells: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.zeros(len(cells), np.int64)
        for column in cells.T:
            out = out * np.int64(1_000_003) + column + 7
    return out


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id, v`` (doubles) of the rows that take part, and their length."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return rows.where(F.size("v") == d), d


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``key, v, ids``: each vector once, with its ``keep`` smallest ids."""
    turn = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("turn", turn).where(F.col("turn") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.element_at("ids", 1).alias("key"), "v", "ids")


def fit(vectors: DataFrame, d: int, k: int, tables: int = 8, recall: float = 0.95, seed: int = 17) -> Index:
    """Projections from the number of vectors; probes from a sample."""
    stats = vectors.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm")).first()
    n, norm = stats["n"], float(np.sqrt(stats["norm"] or 1.0))
    rng = np.random.default_rng(seed)
    m = int(np.clip(round(np.log2(max(2, n / 16)) / 1.5), 2, 16))
    coarse = int(np.clip(round(np.log(max(1, n / GROUP_ROWS)) / np.log(2.5)), 1, m))
    index = Index(rng.normal(size=(tables, d + 1, m)), rng.uniform(0, WIDTH, (tables, m)), coarse, norm, 1)
    share = min(1 << 20, int(FIT_ROWS / max(1, n) * (1 << 20)))
    sample = np.array([r["v"] for r in vectors.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < share).select("v").collect()])
    if len(sample) <= k:
        return Index(index.directions, index.offsets, coarse, norm, 3**m)
    queries = np.random.default_rng(seed).permutation(len(sample))[:FIT_QUERIES]
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :k]
    cells = [_key(np.floor(index.project(t, sample, False)).astype(np.int64)) for t in range(tables)]
    places = [index.project(t, sample[queries], True) for t in range(tables)]
    probes = 2
    while True:
        index = Index(index.directions, index.offsets, coarse, norm, min(probes, 3**m))
        found = np.zeros(best.shape, bool)
        for t in range(tables):
            for i in range(len(queries)):
                found[i] |= np.isin(cells[t][best[i]], _key(index.probed(places[t][i])))
        if found.mean() >= recall or probes >= 3**m:
            return index
        probes = int(probes * 1.5) + 1


def _meet(k: int):
    """Best of a group's vectors for each query that probes them (all, without a list)."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(left) and len(right):
            v, v_key, cell = np.stack(right["v"].to_list()), right["key"].to_numpy(), right["cell"].to_numpy()
            names, at = np.unique(cell, return_inverse=True)
            place = {c: i for i, c in enumerate(names.tolist())}
            largest = np.linalg.norm(v, axis=1).max()
            for begin in range(0, len(left), 256):
                part = left.iloc[begin : begin + 256]
                q, q_key = np.stack(part["v"].to_list()), part["key"].to_numpy()
                score = q @ v.T
                open_ = np.zeros((len(part), len(names)), bool)
                for i, cells in enumerate(part["cells"].to_list()):
                    if len(cells):
                        open_[i, [place[c] for c in cells if c in place]] = True
                    else:
                        open_[i] = True
                score = np.where(open_[:, at.ravel()], score, -np.inf)
                # all that reach the k-th best, ties with it included; products round by less than the margin
                few = min(k, score.shape[1])
                last = -np.partition(-score, few - 1, axis=1)[:, few - 1 : few]
                margin = 1e-12 * np.linalg.norm(q, axis=1, keepdims=True) * largest
                rows, cols = np.nonzero(np.isfinite(score) & (score >= last - margin))
                exact = (q[rows] * v[cols]).sum(axis=1)  # summed alike wherever it stands
                out.append(pd.DataFrame({"q": q_key[rows], "key": v_key[cols], "score": exact}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "key": [], "score": []}).astype({"q": "int64", "key": "int64"})

    return run


FOUND = "q long, key long, score double"


def search(rows: DataFrame, is_query, k: int = 20, tables: int = 8, recall: float = 0.95) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query``: a condition on ``vec_id``."""
    own, d = usable(rows)
    own = saved(own)
    vectors = saved(distinct_vectors(own, k + 1))
    queries = saved(distinct_vectors(own.where(is_query), 1).select("key", "v"))
    index = fit(vectors, d, k, tables, recall)
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def cells(batches, query: bool):
        ix = shared.value
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.stack(pdf["v"].to_list())
            for t in range(tables):
                place = ix.project(t, v, query)
                if not query:
                    cell = np.floor(place).astype(np.int64)
                    yield pd.DataFrame({"tab": t, "grp": _key(cell[:, : ix.coarse]), "cell": _key(cell), "key": pdf["key"], "v": pdf["v"]})
                    continue
                out = []
                for i in range(len(pdf)):
                    probed = ix.probed(place[i])
                    group, cell = _key(probed[:, : ix.coarse]), _key(probed)
                    order = np.argsort(group, kind="stable")
                    cut = np.flatnonzero(np.diff(group[order])) + 1
                    out += [(t, g[0], c, pdf["key"].iloc[i], pdf["v"].iloc[i]) for g, c in zip(np.split(group[order], cut), np.split(cell[order], cut))]
                yield pd.DataFrame(out, columns=["tab", "grp", "cells", "key", "v"])

    indexed = saved(vectors.select("key", "v").mapInPandas(lambda b: cells(b, False), "tab int, grp long, cell long, key long, v array<double>"))
    probing = queries.repartition(shuffle_partitions(rows.sparkSession), "key").mapInPandas(lambda b: cells(b, True), "tab int, grp long, cells array<long>, key long, v array<double>")
    parts = saved(indexed.groupBy("tab", "grp").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("parts")))
    right = indexed.join(parts, ["tab", "grp"]).select("tab", "grp", "cell", "key", "v", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"))
    asked = parts.select(F.col("tab").alias("t"), F.col("grp").alias("g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    left = probing.join(asked, (F.col("tab") == F.col("t")) & (F.col("grp") == F.col("g"))).drop("t", "g")
    by = ["tab", "grp", "part"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(_meet(k), FOUND)
    best = saved(_best(found, k + 1))

    # the exact way for queries with few candidates
    total = vectors.agg(F.sum(F.size("ids")), F.count("*")).first()
    want = min(k + 1, total[0] or 0)
    held = best.join(vectors.select("key", F.size("ids").alias("n")), "key").groupBy("q").agg(F.sum("n").alias("n"))
    short = saved(queries.join(held, queries["key"] == held["q"], "left").where(F.coalesce("n", F.lit(0)) < want).select("key", "v"))
    if short.count():
        blocks = max(1, -(-total[1] // GROUP_ROWS))
        right = vectors.select("key", "v", F.lit(0).cast("long").alias("cell"), F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("part"))
        left = short.select("key", "v", F.expr("cast(array() as array<bigint>)").alias("cells"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).cast("long").alias("part"))
        whole = left.groupBy("part").cogroup(right.groupBy("part")).applyInPandas(_meet(k), FOUND)
        best = best.join(short.select(F.col("key").alias("q")), "q", "left_anti").unionByName(_best(whole, k + 1))

    # back to ids: of all queries with that vector, and of all vectors found
    ids = own.where(is_query).distinct().join(queries.withColumnRenamed("key", "q"), "v").select("q", F.col("vec_id").alias("query_id"))
    named = best.join(vectors.select("key", "ids"), "key").select("q", "score", F.explode("ids").alias("vec_id"))
    pairs = ids.join(named, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    """Of each query the ``k`` best vectors, those of several tables once."""
    turn = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "key"))
    return found.groupBy("q", "key").agg(F.max("score").alias("score")).withColumn("turn", turn).where(F.col("turn") <= k).drop("turn")
