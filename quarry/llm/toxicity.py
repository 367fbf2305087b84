"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as a word vector plus the mean of its character n-gram vectors.  Windows
of ``WINDOW`` words run through a forward and a backward gated recurrent layer (gates are
clipped lines, ``x / 4 + 1/2`` from 0 to 1, states are squashed by ``x / (1 + |x|)``); attention pools the states and a logistic unit
scores the window.  A text's score is its highest window's, and a window starts at every
word.  Overlapping windows read the same projected words: at each step a slice of them.

The classifier is fitted on a bounded sample (``fit_docs`` labelled rows, chosen by a
hash of the id).  A Spark pass counts in how many toxic and clean documents each word and
n-gram stands: each that stands in ``support`` of them gets a vector of its own, all others
share ``HASHED`` vectors by a hash, so every word of a window is read.  A second pass picks
the window of each sampled document with the word that stands in toxic ones most above
chance, and one more window of each clean one; the driver gets those windows only.  As a
clean text must stay low in all its windows, ``hard_rounds`` more passes look for each sampled
clean document's highest window under the current model, and training goes on with them.

Defined cases: null or empty text, or one without words, scores as an empty window; null
labels teach nothing; with one class only, every score is that class's share; several
labels for a document count as toxic if any is; repeated rows are judged alike; other
columns pass through (a column named like a result is replaced).
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from quarry.llm.common import arrow_rows, begin_task, give_back, map_rows, saved

WORD = re.compile(r"[^\W\d_]+")
WINDOW = 32
GRAM = 5
#: Vectors that the words without one of their own share, and those that the n-grams do.
HASHED = 4096
#: Words whose inputs a task keeps, before it starts anew.
CACHE_ENTRIES = 200_000
#: Words whose n-grams a counting task keeps.
FREQUENT = 1 << 14
#: Bytes of texts that are scored at a time, words projected at a time, and windows run at a time.
BATCH_BYTES, SEGMENT, LANES = 512 << 10, 1 << 15, 1 << 11
Params = dict[str, np.ndarray]


def grams_of(word: str) -> set[str]:
    padded = f"<{word}>"
    return {padded[i : i + GRAM] for i in range(max(1, len(padded) - GRAM + 1))}


@dataclass
class Model:
    words: dict[str, int]  # known words and n-grams, from 1 on; 0 is the padding
    grams: dict[str, int]
    params: Params = field(default_factory=dict)
    start: list[np.ndarray] | None = None  # what counts tell of each word and n-gram, to learn from
    constant: float | None = None  # the score, where there is nothing to learn

    def inputs(self, word: str, seen: dict[str, int] | None = None) -> tuple[int, tuple[int, ...]]:
        """The numbers of a word's vector and of its n-grams'; ``seen`` keeps n-grams' numbers."""
        if seen is None:
            seen = {}
        at = []
        for gram in grams_of(word):
            n = seen.get(gram)
            if n is None:
                n = seen[gram] = _number(self.grams, gram)
            at.append(n)
        at.sort()
        return _number(self.words, word), tuple(at)


def _number(known: dict[str, int], name: str) -> int:
    got = known.get(name)
    return len(known) + 1 + zlib.crc32(name.encode("utf-8", "surrogatepass")) % HASHED if got is None else got


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(gate: np.ndarray) -> np.ndarray:
    return 0.25 * ((gate > 0) & (gate < 1))


class Inputs(dict):
    """Numbers words as they come, the padding first; the n-grams of all new words are looked
    up together."""

    def __init__(self, model: Model):
        super().__init__({"": 0})
        self.model, self.new, self.grams, self.parts = model, [], {}, []
        self.keep((np.zeros(1, int), np.empty(0, int), np.zeros(1, int)))

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n

    def look_up(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if self.new:
            self.keep((np.array([_number(self.model.words, w) for w in self.new], int), *self._grams(self.new)))
            self.new = []
        return ids

    def keep(self, flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.parts.append(flat)

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids, n-gram ids one after the other, and how many each input has."""
        return tuple(map(np.concatenate, zip(*self.parts)))

    def _grams(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """N-gram ids of words one after the other, each word's in order, and how many each has."""
        padded = "<" + "><".join(words) + ">"
        code = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
        dense = np.zeros(int(code.max()) + 1, np.uint64)
        dense[code] = 1
        distinct = np.flatnonzero(dense)
        bits = len(distinct).bit_length()
        if bits * GRAM > 64:  # more letters than a number tells apart
            if len(words) == 1:
                grams = self.model.inputs(words[0], self.grams)[1]
                return np.array(grams, int), np.array([len(grams)])
            half = [self._grams(part) for part in (words[: len(words) // 2], words[len(words) // 2 :])]
            return np.concatenate([h[0] for h in half]), np.concatenate([h[1] for h in half])
        dense[distinct] = np.arange(1, len(distinct) + 1, dtype=np.uint64)
        length = np.fromiter(map(len, words), np.int64, len(words)) + 2
        count = np.maximum(length - GRAM + 1, 1)
        owner = np.repeat(np.arange(len(words)), count)
        at = np.arange(len(owner)) + np.repeat(np.cumsum(length) - length - (np.cumsum(count) - count), count)
        code = np.append(dense[code], np.zeros(GRAM, np.uint64))
        key = np.zeros(len(at), np.uint64)
        for k in range(GRAM):
            letter = code[at + k]
            if k > 2:  # no word is shorter than one letter and its two marks
                letter[length[owner] <= k] = 0
            key = key << np.uint64(bits) | letter
        _, first, same = np.unique(key, return_index=True, return_inverse=True)
        seen, number = self.grams, np.empty(len(first), int)
        size = np.minimum(length[owner[first]], GRAM)
        for i, (b, n) in enumerate(zip(at[first].tolist(), size.tolist())):
            gram = padded[b : b + n]
            got = seen.get(gram)
            if got is None:
                got = seen[gram] = _number(self.model.grams, gram)
            number[i] = got
        number = number[same]
        order = np.lexsort((same, number, owner))
        owner, same = owner[order], same[order]
        once = np.ones(len(order), bool)  # an n-gram counts once in a word
        once[1:] = (owner[1:] != owner[:-1]) | (same[1:] != same[:-1])
        return number[order[once]], np.bincount(owner[once], minlength=len(words))


def vectors(p: Params, flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    word, grams, sizes = flat
    out = p["word"][word].copy()
    own = np.flatnonzero(sizes)
    if len(own):
        out[own] += np.add.reduceat(p["gram"][grams], (np.cumsum(sizes) - sizes)[own]) / sizes[own][:, None].astype(out.dtype)
    return out


class Vectors(Inputs):
    """Keeps the vectors of the words only, and starts anew after ``CACHE_ENTRIES`` words."""

    def __init__(self, model: Model):
        self.vectors = np.empty((0, model.params["word"].shape[1] if model.params else 0), np.float32)
        super().__init__(model)

    def keep(self, flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        if self.model.params:
            self.vectors = np.concatenate([self.vectors, vectors(self.model.params, flat)])

    def look_up(self, words: list[str]) -> np.ndarray:
        if len(self) > CACHE_ENTRIES:
            self.clear()
            self.__init__(self.model)
        return super().look_up(words)


def part_of(flat: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``flat`` of the inputs ``at`` only."""
    word, grams, sizes = flat
    own = sizes[at]
    place = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    return word[at], grams[np.repeat((np.cumsum(sizes) - sizes)[at], own) + place], own


def _layer(p: Params, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States [time, row, hidden] of one direction; x: [time, row, 3 * hidden], projected."""
    h_size = p[d + "h"].shape[0]
    h = np.zeros((x.shape[1], h_size), np.float32)
    states, trace = np.empty((x.shape[0], x.shape[1], h_size), np.float32), []
    for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
        a = h @ p[d + "h"]
        zr = _gate(x[t, :, : 2 * h_size] + a[:, : 2 * h_size])
        z, r = zr[:, :h_size], zr[:, h_size:]
        n = _squash(x[t, :, 2 * h_size :] + r * a[:, 2 * h_size :])
        new = n + z * (h - n)
        if keep:
            trace.append((t, h, z, r, n, a[:, 2 * h_size :]))
        h = h + mask[t] * (new - h)
        states[t] = h
    return states, trace


def forward(p: Params, vecs: np.ndarray, ids: np.ndarray, filled: np.ndarray, keep: bool = False):
    """Logits of windows ``ids`` [row, time], of which the first ``filled`` words count."""
    ids = ids.T
    mask = (np.arange(ids.shape[0])[:, None] < np.maximum(filled, 1)[None]).astype(np.float32)[:, :, None]
    layers = [_layer(p, d, (vecs @ p[d + "x"] + p[d + "b"]).astype(np.float32)[ids], mask, keep) for d in "fb"]
    states = np.concatenate([layers[0][0], layers[1][0]], axis=2)
    u = _squash(states @ p["att"])
    e = np.where(mask[:, :, 0] > 0, u @ p["attv"], -1e9)
    e = np.exp(e - e.max(0))
    alpha = e / e.sum(0)
    pooled = (alpha[:, :, None] * states).sum(0)
    logit = pooled @ p["out"] + p["outb"]
    return (logit, (ids, mask, layers, states, u, alpha, pooled)) if keep else logit


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by where they belong, 0 to ``n``."""
    out = np.zeros((n, rows.shape[1]))
    if len(at):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        out[at[order[first]]] = np.add.reduceat(rows[order], first)
    return out


def backward(p: Params, vecs: np.ndarray, flat, kept, dlogit: np.ndarray) -> Params:
    ids, mask, layers, states, u, alpha, pooled = kept
    g = {"out": pooled.T @ dlogit, "outb": dlogit.sum(keepdims=True)}
    dpool = dlogit[:, None] * p["out"]
    dalpha = (states * dpool).sum(2)
    dstates = alpha[:, :, None] * dpool
    de = alpha * (dalpha - (alpha * dalpha).sum(0))
    g["attv"] = np.einsum("tb,tba->a", de, u)
    du = de[:, :, None] * p["attv"] * (1 - np.abs(u)) ** 2
    g["att"] = np.einsum("tbh,tba->ha", states, du)
    dstates = dstates + du @ p["att"].T
    dvecs = np.zeros_like(vecs)
    size = states.shape[2] // 2
    for k, d in enumerate("fb"):
        dx = np.zeros((*ids.shape, 3 * size), np.float32)
        dh, gh = np.zeros((ids.shape[1], size), np.float32), np.zeros_like(p[d + "h"])
        for t, h, z, r, n, an in reversed(layers[k][1]):
            dh = dh + dstates[t][:, k * size : (k + 1) * size]
            dnew, dh = dh * mask[t], dh * (1 - mask[t])
            dn = dnew * (1 - z) * (1 - np.abs(n)) ** 2
            dz, dr = dnew * (h - n) * _slope(z), dn * an * _slope(r)
            dx[t] = np.concatenate([dz, dr, dn], axis=1)
            da = np.concatenate([dz, dr, dn * r], axis=1)
            gh += h.T @ da
            dh = dh + dnew * z + da @ p[d + "h"].T
        g[d + "h"] = gh
        per_input = _sum_rows(ids.ravel(), dx.reshape(-1, 3 * size), len(vecs))
        g[d + "x"], g[d + "b"] = vecs.T @ per_input, per_input.sum(0)
        dvecs += per_input @ p[d + "x"].T
    word, grams, sizes = flat
    owner = np.repeat(np.arange(len(sizes)), sizes)
    g["word"] = _sum_rows(word, dvecs, len(p["word"]))
    g["gram"] = _sum_rows(grams, dvecs[owner] / sizes[owner][:, None], len(p["gram"]))
    return g


def stream_logits(p: Params, vecs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Logits of the full windows that start at each of ``ids`` (but the last ``WINDOW - 1``)."""
    size, count = p["fh"].shape[0], max(0, len(ids) - WINDOW + 1)
    out = np.empty(count, np.float32)
    read = np.concatenate([p["att"].T, p["out"][None]])  # what attention and output read of a state
    # the gates' lines are folded into what they add up
    fold = np.repeat(np.array([0.25, 1], np.float32), [2 * size, size])[:, None]
    shift = np.repeat(np.array([0.5, 0], np.float32), [2 * size, size])[:, None]
    layers = {d: np.ascontiguousarray(p[d + "h"].T) * fold for d in "fb"}
    project = {d: (p[d + "x"].T * fold, p[d + "b"][:, None] * fold) for d in "fb"}
    lanes = min(LANES, count)
    zeros, ones = np.zeros((2 * size, lanes), np.float32), np.ones((2 * size, lanes), np.float32)
    # every block of windows works in the same arrays, small enough to stay in a core's cache
    ahead, a_, new_, whole_ = np.empty((WINDOW, size, lanes), np.float32), *(np.empty((k * size, lanes), np.float32) for k in (3, 1, 1))
    both_, got_, part_ = np.empty((2 * size, lanes), np.float32), np.empty((len(read), lanes), np.float32), np.empty((len(read) - 1, lanes), np.float32)
    e_, told_ = np.empty((WINDOW, lanes), np.float32), np.empty((WINDOW, lanes), np.float32)
    for begin in range(0, count, SEGMENT):
        n = min(SEGMENT, count - begin)
        own = np.ascontiguousarray(vecs[ids[begin : begin + n + WINDOW - 1]].T)
        x = {}
        for d, (by, add) in project.items():
            x[d] = by @ own
            x[d] += add
            x[d] += shift
        for lane in range(0, n, LANES):
            w = min(LANES, n - lane)
            a, new, whole, both, got, part = (v[:, :w] for v in (a_, new_, whole_, both_, got_, part_))
            zr, z, r, an, zero, one = a[: 2 * size], a[:size], a[size : 2 * size], a[2 * size :], zeros[:, :w], ones[:, :w]
            e, told = e_[:, :w], told_[:, :w]
            for k, d in enumerate("fb"):
                h = np.zeros((size, w), np.float32)
                for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
                    word = x[d][:, lane + t : lane + t + w]
                    np.matmul(layers[d], h, out=a)
                    zr += word[: 2 * size]
                    np.maximum(zr, zero, out=zr)
                    np.minimum(zr, one, out=zr)
                    np.multiply(r, an, out=new)
                    new += word[2 * size :]
                    np.abs(new, out=whole)
                    whole += 1
                    new /= whole
                    state = both[size:] if k else ahead[t, :, :w]
                    np.subtract(h, new, out=state)
                    state *= z
                    state += new
                    h = state
                    if k:  # both states at this word are known: what attention and output read of them
                        both[:size] = ahead[t, :, :w]
                        np.matmul(read, both, out=got)
                        u = got[:-1]
                        np.abs(u, out=part)
                        part += 1
                        u /= part
                        np.matmul(p["attv"], u, out=e[t])
                        told[t] = got[-1]
            e -= e.max(0)
            np.exp(e, out=e)
            told *= e
            out[begin + lane : begin + lane + w] = told.sum(0) / e.sum(0) + p["outb"]
    return out


def train(model: Model, windows: list[list[str]], toxic: np.ndarray, hidden: int = 8, width: int = 10, steps: int = 400, batch: int = 128, rate: float = 0.01, seed: int = 5) -> Params:
    """Parameters after ``steps`` steps, from the model's own if it has any."""
    rng = np.random.default_rng(seed)
    inputs = Inputs(model)
    ids = np.zeros((len(windows), WINDOW), np.int32)
    filled = np.array([len(w) for w in windows])
    flat_ids = inputs.look_up([w for ws in windows for w in ws])
    ids[np.arange(WINDOW)[None] < filled[:, None]] = flat_ids
    flat = inputs.flat()
    normal = lambda *s: rng.normal(0, 1 / math.sqrt(s[0]), s)
    p: Params = {"word": 0.1 * rng.normal(size=(len(model.words) + 1 + HASHED, width)), "gram": 0.1 * rng.normal(size=(len(model.grams) + 1 + HASHED, width)), "att": normal(2 * hidden, 8), "attv": normal(8), "out": normal(2 * hidden), "outb": np.zeros(1)}
    for d in "fb":
        p |= {d + "x": normal(width, 3 * hidden), d + "h": normal(hidden, 3 * hidden), d + "b": np.zeros(3 * hidden)}
    for k, told in zip(("word", "gram"), model.start or []):
        p[k][1 : len(told) + 1, 0] += told
    p = {k: model.params[k].astype(np.float64) if k in model.params else x for k, x in p.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    weight = np.where(toxic == 1, min(8.0, 0.5 * len(toxic) / max(1, toxic.sum())), 1.0)
    while step < steps:
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch)[: steps - step]:
            rows = order[at : at + batch]
            used, own = np.unique(ids[rows], return_inverse=True)
            part = part_of(flat, used)
            vecs = vectors(p, part)
            logit, kept = forward(p, vecs, own.reshape(len(rows), WINDOW), filled[rows], keep=True)
            dlogit = (_sigmoid(logit) - toxic[rows]) * weight[rows] / len(rows)
            step += 1
            for k, gk in backward(p, vecs, part, kept, dlogit).items():
                at_k = np.unique(part[0 if k == "word" else 1]) if k in ("word", "gram") else slice(None)  # vectors of this batch only
                gk = gk[at_k]
                m[k][at_k], v[k][at_k] = 0.9 * m[k][at_k] + 0.1 * gk, 0.999 * v[k][at_k] + 0.001 * gk * gk
                p[k][at_k] -= rate * (m[k][at_k] / (1 - 0.9**step)) / (np.sqrt(v[k][at_k] / (1 - 0.999**step)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in p.items()}


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = 10_000, support: int = 5, hard_rounds: int = 2, hard_steps: int = 150, seed: int = 3) -> Model:
    """``docs``: ``doc_id, text``; ``labels``: ``doc_id, toxic`` of the rows to learn from."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = marks.count()
    if total > fit_docs:
        marks = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < F.lit(int(fit_docs / total * (1 << 20))))
    sample = saved(docs.select("doc_id", "text").where("text is not null").join(F.broadcast(marks), "doc_id"))  # marks: fit_docs rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        seen: dict[tuple[int, int], Counter] = {(kind, toxic): Counter() for kind in (0, 1) for toxic in (0, 1)}
        parts = functools.lru_cache(FREQUENT)(grams_of)

        def out() -> Iterator[pa.RecordBatch]:
            for (kind, toxic), n in seen.items():
                counts = pa.array(n.values(), pa.int64(), size=len(n))
                none = pa.array(np.zeros(len(n), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(n.keys(), pa.string(), size=len(n)), none if toxic else counts, counts if toxic else none], names=["kind", "gram", "clean", "toxic"])
                n.clear()

        for batch, texts in arrow_rows(batches, 0, BATCH_BYTES):
            for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
                words = set(WORD.findall(text.lower()))
                seen[0, toxic != 0].update(words)
                seen[1, toxic != 0].update(set().union(*map(parts, words)))
            if sum(map(len, seen.values())) > CACHE_ENTRIES:
                yield from out()
        yield from out()
        del seen, parts
        give_back()

    classes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = classes.get(0, 0), sum(n for k, n in classes.items() if k)
    if not n_clean or not n_toxic:
        return Model({}, {}, constant=float(n_toxic > 0))
    counts = sample.select("text", F.least("toxic", F.lit(1)).alias("toxic")).mapInArrow(count, "kind int, gram string, clean long, toxic long")
    counts = counts.groupBy("kind", "gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    expected = (F.col("clean") + F.col("toxic")) * (n_toxic / (n_clean + n_toxic))
    counts = counts.where(F.col("clean") + F.col("toxic") >= support).withColumn("surprise", (F.col("toxic") - expected) / F.sqrt(expected + 1))
    rows = counts.select("kind", "gram", "surprise").toArrow()  # bounded by the sample
    entry: list[dict[str, float]] = [{}, {}]
    for kind, gram, surprise in zip(*(c.to_pylist() for c in rows.columns)):
        entry[kind][gram] = surprise
    model = Model({w: i + 1 for i, w in enumerate(sorted(entry[0]))}, {w: i + 1 for i, w in enumerate(sorted(entry[1]))})
    model.start = [np.clip([told[w] / 4 for w in sorted(told)], -1, 4) for told in entry]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        suspicion: dict[str, float] = {}
        rows: list[tuple[int, list[str]]] = []
        for batch, texts in arrow_rows(batches, 0, BATCH_BYTES):
            for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
                words = WORD.findall(text.lower())
                if not words:
                    continue
                for w in set(words).difference(suspicion):
                    suspicion[w] = max([0.0, entry[0].get(w, 0.0), *(entry[1].get(x, 0.0) for x in grams_of(w))])
                starts = window_starts(len(words))
                each = np.zeros(starts[-1] + WINDOW)
                each[: len(words)] = [suspicion[w] for w in words]
                best = int(np.lib.stride_tricks.sliding_window_view(each, WINDOW).max(1).argmax())
                rows.append((toxic, words[best : best + WINDOW]))
                if not toxic:
                    other = starts[len(words) * 7919 % len(starts)]
                    rows.append((0, words[other : other + WINDOW]))
            suspicion.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["toxic", "words"])

    # windows of bounded number and length are all that reaches the driver, which orders them:
    # a sort in Spark would make them twice, for its ranges and for itself
    pool: dict[str, str] = {}  # a word that many windows hold is one string

    def ordered(found: DataFrame) -> tuple[list[list[str]], list[float]]:
        rows = []
        for batch in found.toArrow().to_batches(1 << 12):
            rows += [(t, [pool.setdefault(w, w) for w in ws]) for t, ws in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort()
        return [ws for _, ws in rows], [float(t) for t, _ in rows]

    windows, toxic = ordered(sample.select("text", F.least("toxic", F.lit(1)).alias("toxic")).mapInArrow(pick, "toxic int, words array<string>"))
    if len(set(toxic)) < 2:
        return Model({}, {}, constant=n_toxic / (n_clean + n_toxic))
    del entry, rows
    give_back()
    model.params = train(model, windows, np.array(toxic))
    clean = sample.where("toxic = 0").select("text")
    for turn in range(hard_rounds):
        highest, none = ordered(clean.mapInArrow(_highest_windows(model), "words array<string>").select(F.lit(0), "words"))
        windows, toxic = windows + highest, toxic + none
        del highest
        model.params = train(model, windows, np.array(toxic), steps=hard_steps, rate=0.005, seed=seed + turn)
    del windows, pool
    give_back()
    return model


def _highest_windows(model: Model):
    """Of each text the window with the highest score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        score = scorer(model)
        for _, texts in arrow_rows(batches, 0, BATCH_BYTES):
            _, starts, words = score.windows(texts)
            yield pa.RecordBatch.from_arrays([pa.array([w[s : s + WINDOW] for w, s in zip(words, starts) if w], pa.list_(pa.string()))], names=["words"])
        del score
        give_back()

    return run


def window_starts(n: int) -> range:
    """First words of a text's windows: one at every word, the last window reaches the end."""
    return range(max(1, n - WINDOW + 1))


class scorer:  # noqa: N801 - called like the function that it stands for
    """A function from texts to scores; keeps the inputs of words from call to call."""

    def __init__(self, model: Model):
        self.model, self.known = model, Vectors(model)

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Of each text the highest window's logit and first word, and the text's words."""
        words = [WORD.findall(t.lower()) if t else [] for t in texts]
        sizes = np.array([len(w) for w in words], int)
        ids = self.known.look_up([w for ws in words for w in ws])
        best, start = np.empty(len(texts), np.float32), np.zeros(len(texts), int)
        ends = np.cumsum(sizes)
        full = sizes >= WINDOW
        if not full.all():
            short = np.flatnonzero(~full)
            at = (ends - sizes)[short][:, None] + np.arange(WINDOW)[None]
            grid = np.where(np.arange(WINDOW)[None] < sizes[short][:, None], np.append(ids, 0)[np.minimum(at, len(ids))], 0)
            used, own = np.unique(grid, return_inverse=True)
            best[short] = forward(self.model.params, self.known.vectors[used], own.reshape(grid.shape), sizes[short])
        if full.any():
            long = np.flatnonzero(full)
            stream = ids[np.repeat(full, sizes)]
            logits = np.append(stream_logits(self.model.params, self.known.vectors, stream), np.full(WINDOW - 1, -np.inf, np.float32))
            after = np.cumsum(sizes[long])
            for k in range(1, WINDOW):  # windows that would reach into the next text
                logits[after - k] = -np.inf
            best[long] = np.maximum.reduceat(logits, after - sizes[long])
            start[long] = [int(logits[b : b + n].argmax()) for b, n in zip(after - sizes[long], sizes[long])]
        return best, start, words

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        each = list(dict.fromkeys(texts))  # equal texts once
        best = dict(zip(each, _sigmoid(self.windows(each)[0].astype(np.float64)).tolist()))
        return np.array([best[t] for t in texts])


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` added."""
    own = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample
    at = own.columns.index("text")

    def make():
        score = scorer(shared.value)

        def step(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            got = score(texts)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64()), pa.array((got >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

        return step

    schema = StructType([*own.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return map_rows(own, make, schema, at, max_bytes=BATCH_BYTES)
