import math
from collections import Counter

from quarry.operators import lm as LM


def brute_bigram(docs):
    toks = {k: t.lower().split() for k, t in docs}
    big, ctx, vocab = Counter(), Counter(), set()
    for w in toks.values():
        prev = "<s>"
        for x in w:
            big[(prev, x)] += 1
            ctx[prev] += 1
            vocab.add(x)
            prev = x
    v = len(vocab)
    out = {}
    for k, w in toks.items():
        prev, s = "<s>", 0.0
        for x in w:
            s += -math.log((big[(prev, x)] + 1) / (ctx[prev] + v))
            prev = x
        out[k] = math.exp(s / len(w))
    return out


def test_bigram_matches_brute_force(spark):
    docs = [(1, "a b a b c"), (2, "b a c c"), (3, "c")]
    df = spark.createDataFrame(docs, "k int, text string")
    lm = LM.fit_ngram_lm(df, "k", "text", 2)
    got = {r["k"]: r["perplexity"] for r in LM.perplexity(df, lm, "k").collect()}
    want = brute_bigram(docs)
    assert got.keys() == want.keys()
    for k in got:
        assert abs(got[k] - want[k]) < 1e-9


def test_unigram_unseen_token(spark):
    train = spark.createDataFrame([(1, "a a b")], "k int, text string")
    test = spark.createDataFrame([(9, "z")], "k int, text string")
    lm = LM.fit_ngram_lm(train, "k", "text", 1)
    r = LM.perplexity(test, lm, "k").collect()[0]
    assert abs(r["perplexity"] - (3 + 2) / 1) < 1e-9
