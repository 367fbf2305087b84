"""Language identification by word-first backoff.

A word seen in training scores its smoothed log frequency in every language.  An unseen
word falls back to character n-grams: at each position the longest known n-gram (from
``max_gram`` characters down to one) scores, and their mean, less a penalty common to
all languages, stands for the word.  A text's score per language is the sum over its
words; the softmax at a bounded evidence gives the reported score.

The model is fitted on a bounded sample (``fit_docs`` documents, chosen by a hash of the
id); its counts are grouped in Spark, and every text is learnt from and judged whole.

Defined cases: null text, no letter, or nothing learned: ``und`` with score 0; ties go to
the alphabetically first language; repeated rows are judged alike; other columns pass
through untouched (a column named like a result is replaced).
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry.llm.common import give_back, map_rows

WORD = re.compile(r"[^\W\d_]+")  # letters, and signs like ½ that count as numbers
UND = "und"
#: Unseen words whose backoff score a task keeps, before it starts anew.
CACHE_ENTRIES = 50_000
#: Bytes of texts that are scored at a time.
BATCH_BYTES = 1 << 20
#: What a word counts at most for its n-grams: a stop word is not all there is.
GRAM_WEIGHT = 8
#: Each word adds this much of its log likelihood; more would make every score 0 or 1.
EVIDENCE = 0.25


@dataclass(frozen=True)
class Model:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray
    max_gram: int


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    found = WORD.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, found)):
        return found
    return [part for w in found for part in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def _grams(word: str, n: int) -> Iterator[str]:
    padded = f"<{word}>"
    return (padded[i : i + n] for i in range(len(padded) - n + 1))


def fit(labelled: DataFrame, fit_docs: int = 6000, max_gram: int = 4, min_count: int = 3, seed: int = 11) -> Model:
    """``labelled``: ``doc_id, text, lang``; rows with a null text or language teach nothing.  Words and n-grams
    that occur less than ``min_count`` times (a word counts ``GRAM_WEIGHT`` times at most for its n-grams) are left
    out of the model."""
    rows = labelled.select("doc_id", F.col("text").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    total = rows.count()
    if total > fit_docs:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < F.lit(int(fit_docs / total * (1 << 20))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update((lang, w) for w in words_of(text))
        if seen:
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])

    words = rows.select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    model = build((row for batch in words.to_batches(1 << 16) for row in zip(*[c.to_pylist() for c in batch.columns])), words["lang"].unique().to_pylist(), max_gram, min_count)
    del words
    give_back()
    return model


class _Counts:
    """Numbers per key and language, in one flat array."""

    def __init__(self, languages: int):
        self.languages, self.at, self.values = languages, {}, array("d")

    def add(self, key: str, language: int, n: float) -> None:
        i = self.at.setdefault(key, len(self.at)) * self.languages
        if i == len(self.values):
            self.values.extend([0.0] * self.languages)
        self.values[i + language] += n


def build(counts: Iterable[tuple[str, str, int]], languages: list[str], max_gram: int, min_count: int) -> Model:
    languages = sorted(languages)
    at = {x: i for i, x in enumerate(languages)}
    by_word, by_gram = _Counts(len(languages)), _Counts(len(languages))
    for lang, word, n in counts:
        by_word.add(word, at[lang], n)
        for k in range(1, max_gram + 1):
            for g in _grams(word, k):
                by_gram.add(g, at[lang], min(n, GRAM_WEIGHT))

    def scores(table: _Counts, least: float) -> tuple[dict[str, int], np.ndarray]:
        every = np.frombuffer(table.values).reshape(len(table.at), len(languages))
        enough = every.sum(1) >= least
        kept = sorted(k for k, i in table.at.items() if enough[i])
        if not kept:
            return {}, np.zeros((0, len(languages)))
        m = every[[table.at[k] for k in kept]]
        total = every.sum(0)
        return {k: i for i, k in enumerate(kept)}, np.log((m + 0.1) / (total + 0.1 * len(kept) + 1))

    words, word_scores = scores(by_word, min_count)
    grams, gram_scores = scores(by_gram, min_count)
    return Model(languages, words, word_scores, grams, gram_scores, max_gram)


def scorer(model: Model):
    """A function from a text to (language, score)."""
    kept: dict[str, np.ndarray] = {}
    zero = np.zeros(len(model.languages))

    def unseen(word: str) -> np.ndarray:
        got = kept.get(word)
        if got is None:
            padded, total, n = f"<{word}>", zero, 0
            for i in range(len(padded)):
                for k in range(min(model.max_gram, len(padded) - i), 0, -1):
                    at = model.grams.get(padded[i : i + k])
                    if at is not None:
                        total, n = total + model.gram_scores[at], n + 1
                        break
            got = total / n if n else zero
            if len(kept) > CACHE_ENTRIES:
                kept.clear()
            kept[word] = got
        return got

    def score(text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not model.languages:
            return UND, 0.0
        seen: list[int] = []
        add = zero
        n_unseen = Counter()
        find = model.words.get
        for w in words:
            i = find(w)
            if i is None:
                n_unseen[w] += 1
            else:
                seen.append(i)
        if seen:
            add = add + model.word_scores[seen].sum(0)
        for w, n in n_unseen.items():
            add = add + n * unseen(w)
        add = EVIDENCE * (add - add.max())
        p = np.exp(add)
        best = int(np.argmax(add))
        return model.languages[best], min(1.0, float(p[best] / p.sum()))

    return score


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added."""
    own = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample
    at = own.columns.index("text")

    def make():
        score = scorer(shared.value)

        def step(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            got = [score(t) for t in texts]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

        return step

    schema = StructType([*own.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return map_rows(own, make, schema, at, max_bytes=BATCH_BYTES)
