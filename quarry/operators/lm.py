"""Add-one smoothed n-gram language model (n = 1 or 2) and per-row perplexity.

Fitting is a ``groupBy`` count of n-grams (map-side partial aggregation, so a
hot n-gram costs one row per partition).  Bigrams are counted and looked up by
their codes (``grams``).  Scoring looks a row's most frequent ones and contexts up in broadcasts
of bounded size and adds them up without a shuffle; the others are joined with the counts
in one shuffle, bigrams and contexts together.
Perplexity of a row is ``exp(mean(-ln p))`` over its tokens; a summary takes the mean of these
per-row values (not the exp of a mean).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.batches import map_batches
from quarry.operators.grams import CODE, FAR, CodedBatch, GramTable, WordCodes, fit_codes, found_in, gram_counts, near_and_far, token_lists, word_counts
from quarry.operators.joins import HOT_SHARE, lookup
from quarry.operators.layout import stored
from quarry.session import ensure_checkpoint_dir

START = "<s>"


def token_rows(df: DataFrame, key: str, text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """``(key, token)``: the words of ``text_col``, or the elements of the array column
    ``tokens_col`` (e.g. token ids) when given."""
    return token_lists(df, key, text_col, tokens_col).select(key, F.explode("_t").alias("token"))


@dataclass
class NgramLM:
    n: int
    counts: DataFrame  # (prev, token, c) ; prev NULL for n = 1
    context: DataFrame | None  # (prev, c_ctx) for n = 2
    vocab_size: int
    total: int
    n_grams: int = 0  # rows of ``counts``
    n_contexts: int = 0  # rows of ``context``
    codes: WordCodes | None = None  # n = 2: what codes the words of the next two
    grams: GramTable | None = None  # (g, s, c)
    contexts: GramTable | None = None  # (g, s, c), ``g`` below -1 where it is a numbered word


def fit_ngram_lm(df: DataFrame, key: str, text_col: str = "text", n: int = 2, tokens_col: str | None = None) -> NgramLM:
    """Count n-grams once and materialise the model tables.

    The counts are the fitted model, so they are cut from the corpus lineage
    in shared storage; totals and the vocabulary size are read
    from the (much smaller) word counts instead of another corpus pass.
    """
    if n not in (1, 2):
        raise ValueError("n must be 1 or 2")
    ensure_checkpoint_dir(df.sparkSession)
    if n == 1:
        counts = token_rows(df, key, text_col, tokens_col).groupBy("token").agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)
        st = counts.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("v")).collect()[0]
        v = int(st["v"] or 0)
        return NgramLM(1, counts, None, v, int(st["total"] or 0), v, 0)
    lists = token_lists(df, key, text_col, tokens_col)
    words_seen = word_counts(lists)
    st = words_seen.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("v")).collect()[0]
    codes = fit_codes(words_seen, n, START)
    counts = gram_counts(lists, codes)
    context = stored(counts.select(*_context_code(codes), "c").groupBy(*CODE).agg(F.sum("c").alias("c")))
    grams, contexts = GramTable(counts, counts.count()), GramTable(context, context.count())
    words_of = context.withColumn("g", F.when(F.col("g") == -1, F.col("g")).otherwise(-2 - F.col("g")))
    return NgramLM(
        2, codes.decode(counts, ["prev", "token"]), codes.decode(words_of, ["prev"]).withColumnRenamed("c", "c_ctx"),
        int(st["v"] or 0), int(st["total"] or 0), grams.n_rows, contexts.n_rows, codes, grams, contexts,
    )


def _context_code(codes: WordCodes) -> list:
    """A bigram's first word, so coded that no bigram has the same code."""
    g, s = codes.first(1)
    return [F.when(g >= 0, -2 - g).otherwise(g).alias("g"), s.alias("s")]


def _unigram_terms(rows: DataFrame, lm: NgramLM, key: str) -> DataFrame:
    # n-grams holding >= 1/HOT_SHARE of all tokens are at most HOT_SHARE rows: broadcast them.
    hot = lm.counts.where(F.col("c") * F.lit(HOT_SHARE) >= F.lit(lm.total))
    found = lookup(rows, lm.counts, ["token"], lm.n_grams, "left", hot)
    logp = F.log((F.coalesce("c", F.lit(0)).cast("double") + 1.0) / F.lit(float(lm.total + lm.vocab_size)))
    return found.select(key, F.lit(1).cast("bigint").alias("n"), logp.alias("logp"))


def _bigram_terms(lists: DataFrame, lm: NgramLM, key: str) -> DataFrame:
    """``ln(c + 1)`` of each bigram less ``ln(c_ctx + v)`` of its context."""
    v, bits = float(lm.vocab_size), lm.codes.bits
    hot_grams, hot_contexts = lm.grams.hot(), lm.contexts.hot()
    hot = (hot_grams[0], np.log(hot_grams[1] + 1.0), hot_contexts[0], -np.log(hot_contexts[1] + v))
    shared, words_of = lists.sparkSession.sparkContext.broadcast(hot), lm.codes.shared
    out = T.StructType([lists.schema.fields[0], *T.StructType.fromDDL(FAR).fields])
    names = out.fieldNames()

    def look_up(batch: pa.RecordBatch, state: tuple) -> pa.RecordBatch:
        top, (grams, of_gram, contexts, of_context) = state
        coded = CodedBatch(batch.column(1), top, 2, bits)
        at = coded.tokens
        g, before = coded.g[at], np.where(coded.ids[1][at] < 0, -1, -2 - coded.ids[1][at])
        logp = np.zeros(len(coded.g))
        here, value = found_in(grams, of_gram, g)
        logp[at] += value
        known, value = found_in(contexts, of_context, before)
        logp[at] += value
        far = [(at[~here], g[~here], coded.text(at[~here], g[~here])), (at[~known], before[~known], coded.text(at[~known], before[~known], 1))]
        return near_and_far(batch, coded, logp, far, names)

    found = map_batches(lists, look_up, out, lambda: (words_of.value, shared.value))
    found = found.join(lm.grams.cold().unionByName(lm.contexts.cold()), CODE, "left")
    seen = F.coalesce("c", F.lit(0)).cast("double")
    is_context = (F.col("g") < -1) | ((F.col("g") == -1) & ~F.col("s").contains(" "))
    logp = F.when(F.col("n") > 0, F.col("logp")).when(is_context, -F.log(seen + v)).otherwise(F.log(seen + 1.0))
    return found.select(key, "n", logp.alias("logp"))


def perplexity(df: DataFrame, lm: NgramLM, key: str, text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """``(key, n_tokens, perplexity)`` per row; rows without tokens are skipped."""
    if lm.n == 1:
        terms = _unigram_terms(token_rows(df, key, text_col, tokens_col), lm, key)
    else:
        terms = _bigram_terms(token_lists(df, key, text_col, tokens_col), lm, key)
    sums = terms.groupBy(key).agg(F.sum("n").alias("n_tokens"), F.sum("logp").alias("_logp"))
    return sums.select(key, "n_tokens", F.exp(-F.col("_logp") / F.col("n_tokens")).alias("perplexity"))
