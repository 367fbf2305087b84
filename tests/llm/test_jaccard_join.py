import random
import re

import pytest

from quarry.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k, num, den):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(lower))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(s), least[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocab, k=12))
    bases = [rng.choices(vocab, k=rng.choice([2, 5, 9, 30, 80, 200])) for _ in range(30)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases[:6] if i % 3 else bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        text = " ".join(w)
        if rng.random() < 0.3:
            text = line.upper() + "\n" + text
        rows.append((i * 3 % n * 2, text))
    rows += [(9001, None), (9002, ""), (9003, "  \n "), (9004, "one"), (9005, "ONE"), (9006, "a b"), (9007, "b a"), (9008, "É a b"), (9009, "é a b")]
    return rows


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_matches_brute_force(spark, k, num):
    rows = corpus(k)
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k, num, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, k, num, 100)


def test_long_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP_SHINGLES", 500)
    rng = random.Random(4)
    base = [f"x{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(i % 3):
            w[rng.randrange(60)] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 90, 100)


def test_divide_skip_joins_what_links():
    rng = random.Random(1)
    import numpy as np

    t = J.Threshold(80, 100)
    sets = []
    for _ in range(60):
        s = set(rng.sample(range(40), rng.randrange(8, 30)))
        sets.append(np.array(sorted(s), np.uint64))
    root = list(range(60))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in J.divide_skip(sets, t):
        x, y = set(sets[a].tolist()), set(sets[b].tolist())
        assert 100 * len(x & y) >= 80 * len(x | y)
        root[find(a)] = find(b)
    for i in range(60):
        for j in range(i):
            x, y = set(sets[i].tolist()), set(sets[j].tolist())
            if 100 * len(x & y) >= 80 * len(x | y):
                assert find(i) == find(j)


def test_empty_repeated_rows_and_clashing_columns(spark):
    schema = "doc_id long, text string, fp string, size string, grp int"
    assert J.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(5, "a b c d e f", "x", "y", 1), (5, "a b c d e f", "x", "y", 1), (2, "a b c d e f", None, None, None), (None, "a b c d e f", None, None, None), (None, None, None, None, None)]
    got = J.jaccard_components(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.n_shingles) == [(-1, 2, 2), (2, 2, 2), (5, 2, 2), (5, 2, 2)]
    assert [(r.doc_id, r.component_id) for r in got if not r.n_shingles] == [(None, None)]


def test_short_texts_in_other_orders_are_other_sets(spark):
    texts = ["a b c d", "a c b d", "a d c b", "A b c d", "a b c", "a c b", "b a c", "a b", "b a"]
    rows = [(i, text) for i, text in enumerate(texts)]
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 80, 100)
