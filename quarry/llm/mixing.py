"""Mixing to target weights with soft membership, with Spark's own functions only.

A labelled table names the domain of some documents (its label columns together).  A
naive Bayes classifier over hashed words, fitted on a bounded sample of labelled rows
(``FIT_DOCS``), gives every document a posterior over the domains; a temperature chosen on
that sample keeps it calibrated.  Then every document gets a rate ``w >= 0`` such that the
expected tokens per domain, ``sum(n * p * w)``, match the targets: projected gradient on

    1/2 sum_d ((total_d - target_d) / N)^2 / share_d  +  RIDGE/2 sum_i n_i/N (w_i - 1)^2

An iteration is one aggregate over the whole table of posteriors, of which the driver
gets one number per domain.  A rate follows from a document's posterior and those
numbers alone, so rates are put on rows without a join.

Defined cases: a null text or one without words has no tokens and the prior as posterior;
a null label column is a domain of its own; labels of absent documents and null ids teach
nothing; several labels for a document all count; nothing labelled: every rate is 1;
targets of domains that nobody has are left out, the others scaled up; repeated rows are
rated alike; an empty table gives no rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

FIT_DOCS = 8000
BUCKETS = 1 << 14
TEMPERATURES = (1.0, 0.5, 0.2, 0.1, 0.05, 0.02, 0.01)
RIDGE = 1e-3
#: Steps that are written out as one expression before the rates are saved.
CHAIN = 10


@dataclass(frozen=True)
class Classifier:
    domains: list[str]
    prior: list[float]
    weights: list[list[float]]  # per domain after the first: log odds of each bucket against the first
    temperature: float = 1.0


def _constant(values: list) -> Column:
    """An array as one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def _buckets(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\r\\f\\x0B]+"), "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, columns: list[str], seed: int = 19) -> Classifier:
    """``docs``: ``doc_id, text``; ``labels``: ``doc_id`` and ``columns``."""
    name = F.concat_ws("_", *[F.concat(F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("none"))) for c in columns])
    marks = labels.where("doc_id is not null").select(F.col("doc_id").alias("_id"), name.alias("_domain")).distinct()
    total = marks.count()
    if total > FIT_DOCS:
        marks = marks.where(F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 20)) < int(FIT_DOCS / total * (1 << 20)))
    rows = docs.join(F.broadcast(marks), F.col("doc_id") == F.col("_id")).select("_domain", _buckets(F.col("text")).alias("_b"))  # marks: FIT_DOCS rows
    rows = saved(rows)
    sizes = {r["_domain"]: r["n"] for r in rows.groupBy("_domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes)
    if not domains:
        return Classifier([], [], [])
    counts = np.full((len(domains), BUCKETS), 0.5)
    for r in rows.select("_domain", F.explode("_b").alias("b")).groupBy("_domain", "b").agg(F.count("*").alias("n")).collect():  # domains x BUCKETS rows at most
        counts[domains.index(r["_domain"]), r["b"]] += r["n"]
    logs = np.log(counts / counts.sum(1, keepdims=True))
    prior = [float(np.log(sizes[d] / sum(sizes.values()))) for d in domains]
    weights = [[round(float(x), 4) for x in logs[k] - logs[0]] for k in range(1, len(domains))]
    best = Classifier(domains, prior, weights)
    if len(domains) > 1:
        scored = rows.withColumn("_s", _evidence(best, F.col("_b")))
        own = F.array_position(F.array(*map(F.lit, domains)), F.col("_domain")).cast("int")
        losses = [F.sum(-F.log(F.element_at(_softmax(best, F.col("_s"), t), own) + 1e-9)).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
        loss = scored.agg(*losses).first()
        best = Classifier(domains, prior, weights, TEMPERATURES[int(np.argmin([x if x is not None else np.inf for x in loss]))])
    return best


def _evidence(c: Classifier, buckets: Column) -> Column:
    def total(weights: list[float]) -> Column:
        table = _constant(weights)
        return F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.get(table, b))

    return F.array(F.lit(0.0), *map(total, c.weights))


def _softmax(c: Classifier, evidence: Column, temperature: float) -> Column:
    logits = [F.lit(p) + F.lit(temperature) * F.get(evidence, F.lit(k)) for k, p in enumerate(c.prior)]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    weights = [F.exp(x - top) for x in logits]
    return F.array(*[w / sum(weights[1:], weights[0]) for w in weights])


def with_posterior(docs: DataFrame, c: Classifier) -> DataFrame:
    """``docs`` with ``_n`` (words) and ``_p`` (posterior, in the order of ``c.domains``)."""
    out = docs.withColumn("_b", _buckets(F.col("text"))).withColumn("_n", F.size("_b").cast("long"))
    return out.withColumn("_s", _evidence(c, F.col("_b"))).drop("_b").withColumn("_p", _softmax(c, F.col("_s"), c.temperature)).drop("_s")


def _step(w: Column, step: float, residual: list[float]) -> Column:
    """One projected gradient step; the residuals are scaled by the domains' shares."""
    pull = sum((F.get("_p", F.lit(k)) * F.lit(step * r) for k, r in enumerate(residual)), F.lit(0.0))
    return F.greatest(F.lit(0.0), w * F.lit(1 - step * RIDGE) + F.lit(step * RIDGE) - pull)


@dataclass(frozen=True)
class Rates:
    """What the rates follow from: the step length and each step's scaled residuals."""

    step: float
    residuals: list[list[float]]

    def of_row(self) -> Column:
        if not self.residuals:
            return F.lit(1.0)
        each = F.from_json(F.lit(json.dumps(self.residuals)), "array<array<double>>")
        pull = lambda r: F.aggregate(F.zip_with("_p", r, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        return F.aggregate(each, F.lit(1.0), lambda w, r: F.greatest(F.lit(0.0), w * F.lit(1 - self.step * RIDGE) + F.lit(self.step * RIDGE) - F.lit(self.step) * pull(r)))


def solve(posteriors: DataFrame, c: Classifier, targets: dict[str, float], steps: int = 60, close: float = 1e-4) -> Rates:
    """``posteriors``: ``_n, _p``.  Ends when every domain's residual, relative to its
    share, is below ``close`` or no longer falls, at the latest after ``steps`` steps."""
    k = len(c.domains)
    wanted = np.array([max(0.0, targets.get(d, 0.0)) for d in c.domains])
    if not k or not wanted.sum():
        return Rates(1.0, [])
    p = [F.get("_p", F.lit(i)) for i in range(k)]
    gram = posteriors.agg(F.sum("_n").cast("double"), *[F.sum(F.col("_n") * p[i] * p[j]) for i in range(k) for j in range(i, k)], *[F.sum(F.col("_n") * x) for x in p]).first()
    total = gram[0] or 0.0
    if not total:
        return Rates(1.0, [])
    m, it = np.zeros((k, k)), iter(gram[1:])
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = next(it) / total
    share = np.maximum(np.array([next(it) for _ in range(k)]) / total, 1e-6)
    wanted = wanted / wanted.sum()
    step = float(1 / (np.linalg.eigvalsh(m / np.sqrt(np.outer(share, share)))[-1] + RIDGE))
    now, w, residuals, last = posteriors.select("_n", "_p"), F.lit(1.0), [], np.inf
    for turn in range(steps):
        held = now.agg(*[F.sum(F.col("_n") * x * w) for x in p]).first()
        residual = (np.array(held) / total - wanted) / share
        off = float(np.abs(residual).max())
        if off < close or off > last * 0.999:
            break
        last = off
        residuals.append([float(x) for x in residual])
        w = _step(w, step, residuals[-1])
        if turn % CHAIN == CHAIN - 1:
            now, w = saved(now.select("_n", "_p", w.alias("_w"))), F.col("_w")
    return Rates(step, residuals)


def mix(docs: DataFrame, labels: DataFrame, columns: list[str], targets: dict[str, float]) -> DataFrame:
    """``docs`` with ``n_tokens``, ``posterior`` (a map by domain) and ``rate``."""
    own = docs.drop("n_tokens", "posterior", "rate")
    c = fit(own.select("doc_id", "text"), labels, columns)
    if not c.domains:
        none = F.expr("cast(map() as map<string,double>)")
        return own.withColumn("n_tokens", F.size(_buckets(F.col("text"))).cast("long")).withColumn("posterior", none).withColumn("rate", F.lit(1.0))
    rated = solve(saved(with_posterior(own.select("text"), c).select("_n", "_p")), c, targets)
    named = F.map_from_arrays(F.array(*map(F.lit, c.domains)), F.col("_p"))
    return with_posterior(own, c).withColumn("rate", rated.of_row()).withColumn("n_tokens", F.col("_n")).withColumn("posterior", named).drop("_n", "_p")


def resample(docs: DataFrame, labels: DataFrame, columns: list[str], targets: dict[str, float], seed: int = 23) -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part, and once more with
    the rest as probability (by a hash of the id, so that a rerun draws alike)."""
    names = docs.columns
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = mix(docs, labels, columns, targets)
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    return rated.select(*names, F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy")).drop("_copy")
