"""Results of operators that SQL can't express, against plain computations on small tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import language_id, mixing

EN = "the of and to in is was for that with as on at it are".split()
DE = "der die und das ist nicht ein zu den mit auf für von dem im".split()
FR = "le la et les des est une dans pour que qui sur pas au plus".split()


def sentence(gen, words, n):
    return " ".join(gen.choice(words) + gen.choice(["", "", "en", "ly", "heit"]) for _ in range(n))


def test_language_scores_equal_plain_ones(spark):
    """Known words by their log frequency, unseen ones by the longest known n-gram at each place."""
    gen = random.Random(4)
    lexicon = {"en": EN, "de": DE, "fr": FR}
    rows = [(i, sentence(gen, lexicon[lang], 12), lang) for i, lang in enumerate(["en", "de", "fr", "de"] * 15)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    by_word, by_gram = {x: Counter() for x in lexicon}, {x: Counter() for x in lexicon}
    for _, text, lang in rows:
        by_word[lang].update(re.findall("[a-zü]+", text))
    for lang, counts in by_word.items():
        for word, n in counts.items():
            marked = "<" + word + ">"
            for size in (1, 2, 3, 4):
                for i in range(len(marked) - size + 1):
                    by_gram[lang][marked[i : i + size]] += min(n, 8)

    def logs(table):
        kept = {k for c in table.values() for k in c if sum(x[k] for x in table.values()) >= 3}
        return {k: {x: math.log((c[k] + 0.1) / (sum(c.values()) + 0.1 * len(kept) + 1)) for x, c in table.items()} for k in kept}

    words, grams = logs(by_word), logs(by_gram)

    def of_word(word, lang):
        if word in words:
            return words[word][lang]
        marked, found = "<" + word + ">", []
        for i in range(len(marked)):
            known = [marked[i : i + n] for n in (4, 3, 2, 1) if i + n <= len(marked) and marked[i : i + n] in grams]
            found += [grams[known[0]][lang]] if known else []
        return sum(found) / len(found) if found else 0.0

    tests = [(i, sentence(gen, words_of, n)) for i, (words_of, n) in enumerate([(EN, 1), (DE, 2), (FR, 3), (EN + FR, 6), (DE + EN, 40)] * 4)]
    tests += [(50, "theofheit"), (51, "zuzu qqq"), (52, "qqq"), (53, "le le le und")]
    unseen = 0
    for r in language_id.identify(spark.createDataFrame(tests, "doc_id long, text string"), model).collect():
        found = re.findall("[a-zü]+", dict(tests)[r.doc_id])
        unseen += sum(w not in words for w in found)
        weight = {x: math.exp(0.25 * sum(of_word(w, x) for w in found)) for x in lexicon}
        assert weight[r.lang_pred] == pytest.approx(max(weight.values()))
        assert r.score == pytest.approx(weight[r.lang_pred] / sum(weight.values()))
    assert unseen > 5


@pytest.mark.parametrize("share", [0.5, 0.02])
def test_mixing_rates_reach_the_least_squares_optimum(spark, share):
    """The objective at the rates is that of an independent bounded least squares solution."""
    gen = random.Random(5)
    rows = [(i, sentence(gen, EN if i % 4 else DE, 5 + i % 30)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 4 else 0, None) for i in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels, ["quality"], {"quality0": share, "quality1": 1 - share}).collect()
    n = np.array([r.n_tokens for r in got], float)
    p = np.array([[r.posterior["quality0"], r.posterior["quality1"]] for r in got])
    rate = np.array([r.rate for r in got])
    target, own = np.array([share, 1 - share]), n / n.sum()
    of_domain = own @ p

    def cost(w):
        return 0.5 * (((own * w) @ p - target) ** 2 / of_domain).sum() + mixing.RIDGE / 2 * (own * (w - 1) ** 2).sum()

    # at the optimum w = max(0, 1 - p.pull / RIDGE) with pull = (totals - target) / of_domain: Newton on pull
    pull = np.zeros(2)
    for _ in range(200):
        best = np.maximum(0.0, 1 - p @ pull / mixing.RIDGE)
        off = of_domain * pull + target - (own * best) @ p
        bend = np.diag(of_domain) + (p * (own * (best > 0) / mixing.RIDGE)[:, None]).T @ p
        pull = pull - 0.5 * np.linalg.solve(bend, off)
    assert np.abs(off).max() < 1e-9
    assert rate.min() >= 0 and cost(best) <= cost(rate) + 1e-12
    assert cost(rate) - cost(best) < 0.01 * (cost(np.ones(len(n))) - cost(best)) + 1e-9
