"""Small brute-force tests of the operators, one per operator and its edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import ann, components, fingerprints, language_id, lm_scoring, mixing, packing, toxicity, url_filter, warc
from quarry.llm.queries import tokenizer_path

rng = random.Random(3)
EN = "the of and to in is that it was for on are with as be at".split()
DE = "der die und das nicht von sie ist des sich mit dem dass er es".split()


def sentence(words, n):
    return " ".join(rng.choices(words, k=n))


# ------------------------------------------------------------------ components


def test_components_match_union_find(spark):
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(root)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --------------------------------------------------------------------- packing


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    texts = [None, "", " ", "a  b", "Hello, world.\nNext line. ", "don't <|endoftext|> x1 ½² naïve é b", "  lead", "tail\n\n", sentence(EN, 900), "x" * 5000, sentence(DE, 40), sentence(DE, 40)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, "a  b", "again"), (None, "null id", None)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, sequence_id string"), tokenizer_path(), seq_len=64, group_rows=5).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for _, t, _ in rows]
    want = Counter()
    for (doc, _, _), x in zip(rows, ids):
        for s in range(0, len(x), 64):
            want[doc, s, len(x[s : s + 64]), zlib.crc32(np.asarray(x[s : s + 64], "<u4").tobytes()), len(x)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed) == want
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0


def test_first_fit_decreasing_matches_scan():
    lengths = np.array([rng.randrange(1, 100) for _ in range(300)])
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if at == len(room):
            room.append(100)
        want[i] = (at, 100 - room[at])
        room[at] -= lengths[i]
    assert {i: (bins[i], offsets[i]) for i in range(300)} == want


# ----------------------------------------------------------------- language ID


def test_language_id(spark):
    rows = [(i, sentence(EN if i % 2 else DE, 30), "en" if i % 2 else "de", "x") for i in range(80)]
    model = language_id.fit(spark.createDataFrame([*rows, (900, None, "en", ""), (901, "text", None, "")], "doc_id long, text string, lang string, score string"))
    tests = [(1, sentence(EN, 12), 1), (2, sentence(DE, 12), 2), (3, "undasnicht", 3), (4, None, 4), (5, "", 5), (6, "123 !?", 6), (None, "the", 7), (1, sentence(EN, 12), 1)]
    got = language_id.identify(spark.createDataFrame(tests, "doc_id long, text string, score int"), model).collect()
    assert [r.lang_pred for r in got[:2]] == ["en", "de"] and [r.lang_pred for r in got[3:6]] == ["und"] * 3
    assert got[2].lang_pred == "de" and got[6].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)
    numerals = language_id.identify(spark.createDataFrame([(i, t) for i, t in enumerate(["½ ²", "①", "1½the", "ª"])], "doc_id long, text string"), model).collect()
    assert [r.lang_pred == "und" for r in sorted(numerals, key=lambda r: r.doc_id)] == [True, True, False, False]
    nothing = language_id.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert language_id.identify(spark.createDataFrame([(1, "the")], "doc_id long, text string"), nothing).first().lang_pred == "und"


# ------------------------------------------------------------------ URL filter


RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"), url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/")]


def test_rules_and_aliases(spark):
    canon = '<html><head><link rel="canonical" href="{}"></head></html>'
    pages = [
        (1, "http://A.Example.com/en/1", None), (2, "http://www.example.com/en/1", ""), (3, "https://b.net/es/x?q", "<p>"), (4, "https://c.org/x", canon.format("https://b.net/es/x?q")),
        (5, "https://d.org/y#f", '<meta http-equiv="refresh" content="0; url=https://c.org/x">'), (6, "https://e.com/z", canon.format("https://c.org/x")), (7, "https://f.org/", canon.format("https://g.org/")),
        (8, None, "x"), (9, "no scheme", "x"), (10, "https://netx/es/", ""), (11, "https://h.org/rel", canon.format("/es")), (4, "https://c.org/x", canon.format("https://b.net/es/x?q")),
    ]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    want = {1: ("example.com/en/", "block"), 2: ("www.example.com/en/", "allow"), 3: ("net/es/", "block"), 4: (None, "block"), 5: (None, "block"), 6: ("com/", "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow")}
    assert {k: (r.rule, r.verdict) for k, r in got.items()} == want
    assert (got[1].host, got[1].path) == ("a.example.com", "/en/1") and (got[8].host, got[8].path) == ("", "")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0


# ---------------------------------------------------------------- fingerprints


def brute_codes(text):
    import xxhash

    words = [w for w in re.split(r"[ \t\n\r\f\x0b]+", (text or "").lower()) if w]
    if not words:
        return []
    bins = {}
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h & (1 << 64) - 1)
        h = h - (1 << 64) if h >= 1 << 63 else h
        b = (h >> fingerprints._SHIFT) - fingerprints._LOW
        bins[b] = min(bins.get(b, h), h)
    out = []
    for b, order in enumerate(fingerprints._probe_orders()):
        donor = b if b in bins else next(j - 1 for j in order if j - 1 in bins)
        out.append(bins[donor] & 255)
    return out


def test_fingerprints_match_brute_force(spark):
    texts = [sentence(EN, n) for n in (0, 1, 4, 5, 6, 60, 400)] + [None, "É a  b\n", sentence(DE, 50)]
    rows = [(10 * i, t, "x") for i, t in enumerate(texts)] + [(15, "one more", "x"), (15, "one more", "x")]
    got = {}
    for r in fingerprints.edited(spark.createDataFrame(rows, "doc_id long, text string, head string")).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    order = sorted({(d, t or "") for d, t, _ in rows})
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        for r in got[d]:
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert r.fingerprint == "".join(f"{c:02x}" for c in brute_codes(t))
            assert r.edited_fingerprint == "".join(f"{c:02x}" for c in brute_codes(edited))
            a, b = brute_codes(t), brute_codes(nxt)
            same = sum(x == y for x, y in zip(a, b)) / fingerprints.BINS
            want = max(0.0, (same - 1 / 256) / (1 - 1 / 256)) if a and b else float(len(a) == len(b))
            assert r.near_next == pytest.approx(want)
    assert fingerprints.edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    single = fingerprints.edited(spark.createDataFrame([(None, "a b c d e f")], "doc_id long, text string")).first()
    assert single.near_next == 1.0


# ---------------------------------------------------------------------- mixing


def test_mixing_meets_targets_and_optimum(spark):
    rows = [(i, sentence(EN if i % 3 else DE, 5 + i % 40)) for i in range(300)] + [(900, None), (901, ""), (None, "the of")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, rate double")
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, None) for i in range(0, 300, 2)] + [(5000, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = mixing.mix(docs, labels, ["quality"], {"quality1": 0.5, "quality0": 0.5, "absent": 3.0}).collect()
    n = np.array([r.n_tokens for r in got], float)
    p = np.array([[r.posterior["quality0"], r.posterior["quality1"]] for r in got])
    w = np.array([r.rate for r in got])
    assert (w >= 0).all()
    total = (n[:, None] * p * w[:, None]).sum(0) / n.sum()
    assert np.allclose(total, 0.5, atol=2e-3)
    assert all(np.allclose(r.posterior["quality0"] + r.posterior["quality1"], 1) for r in got)
    plain = mixing.mix(docs, labels.limit(0), ["quality"], {"quality1": 1.0}).collect()
    assert {r.rate for r in plain} == {1.0} and mixing.mix(docs.limit(0), labels, ["quality"], {"quality1": 1.0}).count() == 0


# -------------------------------------------------------------------- toxicity


def test_gradients_match_finite_differences():
    model = toxicity.Model({"bad": 1, "of": 2}, {"<bad>": 1})
    windows = [["bad", "the", "of"], ["the"], ["of"] * 32]
    inputs = toxicity.Inputs(model)
    ids = np.zeros((3, toxicity.WINDOW), np.int32)
    filled = np.array([len(w) for w in windows])
    ids[np.arange(toxicity.WINDOW)[None] < filled[:, None]] = inputs.look_up([w for ws in windows for w in ws])
    p = {k: v.astype(float) for k, v in toxicity.train(model, windows, np.array([1.0, 0, 0]), hidden=3, width=4, steps=1).items()}
    flat = inputs.flat()
    loss = lambda p: toxicity.forward(p, toxicity.vectors(p, flat), ids, filled).sum()
    vecs = toxicity.vectors(p, flat)
    _, kept = toxicity.forward(p, vecs, ids, filled, keep=True)
    grads = toxicity.backward(p, vecs, flat, kept, np.ones(3))
    for name in ("fx", "bh", "att", "word", "gram", "out"):
        at = tuple(s // 2 for s in p[name].shape)
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert grads[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.08, abs=2e-3)


def test_toxicity_learns_and_reads_whole_texts(spark):
    docs, labels = [], []
    for i in range(240):
        words = [rng.choice(EN + DE) for _ in range(rng.choice([5, 60, 300]))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = "vileword"
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(i % 4 == 0)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, predicted string")
    model = toxicity.fit(frame, spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int"))
    tests = [(1, sentence(EN, 500) + " vileword", 1), (2, sentence(EN, 500), 0), (3, None, 0), (4, "", 0), (5, "vileword", 1), (5, "vileword", 1)]
    got = toxicity.judge(spark.createDataFrame([t[:2] for t in tests], "doc_id long, text string"), model).collect()
    assert [r.predicted for r in got] == [t[2] for t in tests] and all(0 <= r.score <= 1 for r in got)
    one = toxicity.fit(frame, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert toxicity.judge(frame, one).first().score == 0.0


# ------------------------------------------------------------------------ WARC


def test_warc_round_trip_and_order(spark):
    pages = [(i, f"https://h{i % 5}.example.org/p{i % 3}", f"<p>{i % 7}</p>" if i % 2 else f"é{i}") for i in range(60)] + [(70, None, None), (71, "http://x.org/a b\r\nc", ""), (None, "https://y.org", "WARC/1.1\r\n\r\n"), (3, "https://h3.example.org/p0", "<p>3</p>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    got = warc.captures(df).collect()
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    seen = Counter()
    for i, _, html in pages:
        data, top = (html or "").encode(), first.get(html or "")
        import base64

        kind = "response" if i == top or top is None else "revisit"
        seen[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, None if kind == "response" else top] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == seen
    ordered = sorted(got, key=lambda r: (r.shard, r.position))
    keys = [(r.url_key, r.captured_at) for r in ordered]
    assert keys == sorted(keys)
    assert warc.captures(df.limit(0)).count() == 0


def test_loser_tree_matches_sort():
    for k in (0, 1, 2, 3, 7):
        runs = [sorted((rng.randrange(20), i, j) for j in range(rng.randrange(6))) for i in range(k)]
        assert list(warc.loser_tree_merge(runs)) == sorted(x for r in runs for x in r)


# ------------------------------------------------------------------------- ANN


def test_ann_recall_ties_and_bad_vectors(spark):
    gen = np.random.default_rng(1)
    x = gen.normal(size=(700, 12)).astype(np.float32)
    x[100:160] = x[99]  # equal vectors: ties go to the smaller id
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    bad = [(2000, None, 0), (2001, [0.0] * 12, 0), (2002, [1.0, float("nan")] + [0.0] * 10, 0), (2003, [None] + [1.0] * 11, 0), (2004, [1.0], 0), (2020, [float("inf")] * 12, 0), (None, [1.0] * 12, 0)]
    df = spark.createDataFrame([*rows, rows[5], *bad], "vec_id long, embedding array<float>, cell int")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(range(0, 700, 20))
    hit = 0
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        s = x.astype(float) @ x[q].astype(float)
        best = sorted((i for i in range(700) if i != q), key=lambda i: (-round(s[i], 12), i))[:20]
        hit += len({r.vec_id for r in found} & set(best))
        assert [r["rank"] for r in found] == list(range(1, 21)) and all(abs(r.score - s[r.vec_id]) < 1e-9 for r in found)
        assert all((a.score, -a.vec_id) >= (b.score, -b.vec_id) for a, b in zip(found, found[1:]))
    assert hit >= 0.9 * 20 * len(got)
    # distinct vectors that all tie for one query: the smaller ids win
    tied = [(0, [1.0, 0.0]), *[(i, [0.5, i / 100.0]) for i in range(1, 60)]]
    got = ann.search(spark.createDataFrame(tied, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r.vec_id for r in got) == list(range(1, 21))
    few = ann.search(df.where("vec_id < 4"), F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 1), (0, 2), (0, 3)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------------ LM scoring


def test_lm_scoring(spark):
    copied = sentence(EN, 60)
    rows = [(i, sentence(EN + DE, 60)) for i in range(150)] + [(500 + i, copied + " " + sentence(DE, 3)) for i in range(8)] + [(700, None), (701, ""), (702, "TheÉ ZZZ\tqqq"), (None, "the")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    train = F.coalesce(F.col("doc_id") % 5, F.lit(0)) != 2
    got = {r.doc_id: r for r in lm_scoring.score(df, train).collect()}
    tokens = {d: lm_scoring.tokens_of(t) for d, t in rows}
    counts = Counter(t for d, x in tokens.items() if (d or 0) % 5 != 2 for t in x)
    n, v = sum(counts.values()), len(counts)
    for d, x in tokens.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(counts[t] > 0 for t in x), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in x))
        assert r.score < 0
    held = [r for d, r in got.items() if (d or 0) % 5 == 2 and d is not None and d < 600]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm_scoring.score(df.limit(0), train).count() == 0


def test_tree_codes_are_a_distribution():
    tree = lm_scoring.huffman(np.array([5.0, 1, 0, 100, 7, 0, 2]))
    assert sum(2.0 ** -int(n) for n in tree.length) == pytest.approx(1.0)
    words = {b"a": 0, b"b": 1}
    model = lm_scoring.Model(words, 2, lm_scoring.huffman(np.array([3.0, 2, 1])), lm_scoring.huffman(np.ones(256)), 16, np.zeros(lm_scoring.CONTEXTS << 16, np.uint16),
                             np.zeros(int(lm_scoring._BASE[-1]), np.uint16), lm_scoring.start_weights(), np.zeros(lm_scoring.RANGES))
    mass = sum(math.exp(-lm_scoring.score_batch(model, [[w]])[0]) for w in (b"a", b"b"))
    spelled = sum(math.exp(-lm_scoring.score_batch(model, [[bytes([x])]])[0]) for x in range(256) if bytes([x]) not in words and x != 32)
    assert 0 < mass < 1 and mass + spelled <= 1


def plain_nats(model, counts, texts, tokens):
    """The cost of one document's tokens by dictionaries of whole contexts, decision by decision."""
    words, escape = model.words, len(model.words)

    def path(tree, symbol):
        at = int(tree.offset[symbol])
        return [(int(tree.node[i]), int(tree.bit[i])) for i in range(at, at + int(tree.length[symbol]))]

    def around(doc, i):
        one, two = doc[i - 1] if i >= 1 else None, doc[i - 2] if i >= 2 else None
        return [("one", one), ("two", two), ("both", one, two)]

    def spelled(token):
        whole = token + b" "
        for i, byte in enumerate(whole):
            before = b" " * 4 + whole[:i]
            yield [(k, before[len(before) - k :]) for k in lm_scoring.ORDERS] + [("all", whole[:i])], path(model.byte_tree, byte)

    seen: dict = {}

    def count(contexts, steps, n):
        for c in contexts:
            for node, bit in steps:
                seen.setdefault((c, node), [0, 0])[bit] += n

    for doc in texts:
        for i, t in enumerate(doc):
            count(around(doc, i), path(model.word_tree, words.get(t, escape)), 1)
            if t in words and counts[t] == 1:
                count(around(doc, i), path(model.word_tree, escape), 1)
    for t, n in counts.items():
        if t not in words or n == 1:
            for contexts, steps in spelled(t):
                count(contexts, steps, n)

    def kept(n):  # counts are stored in steps beyond 64
        return n if n <= 64 else 64 * 2 ** (round(5.6 * math.log2(n / 64)) / 5.6)

    def inputs(contexts, node):
        n = [[kept(x) for x in seen.get((c, node), (0, 0))] for c in contexts]
        return [math.log((b + 0.4) / (a + 0.4)) for a, b in n], [a + b for a, b in n]

    weights, refine, cost = model.weights.astype(float).copy(), model.refine.astype(float).copy(), 0.0
    for begin in range(0, len(tokens), lm_scoring.BLOCK):
        block = range(begin, min(begin + lm_scoring.BLOCK, len(tokens)))
        for part in ("word", "byte"):
            cases = []
            for i in block:
                symbol = words.get(tokens[i], escape)
                if part == "word":
                    for node, bit in path(model.word_tree, symbol):
                        x, n = inputs(around(tokens, i), node)
                        sure = [sum(m >= least for least in (1, 4, 32)) for m in n]
                        cases.append(([float(model.word_tree.odds[node]), *x], lm_scoring.LEVELS + 4 * sure[0] + sure[2], bit))
                elif symbol == escape:
                    for contexts, steps in spelled(tokens[i]):
                        for node, bit in steps:
                            x, n = inputs(contexts, node)
                            cases.append((x, min(5, math.ceil(math.log2(n[3] + 1) / 1.6)), bit))
            moved = []
            for x, gate, bit in cases:
                s = sum(a * b for a, b in zip(x, weights[gate]))
                span = int(min(max(s + lm_scoring.RANGES // 2 + 0.5, 0), lm_scoring.RANGES - 1))
                p = 1 / (1 + math.exp(-min(max(s + refine[span], -16), 16)))
                cost -= math.log(p if bit else 1 - p)
                moved.append((x, gate, span, bit - p))
            if begin + lm_scoring.BLOCK < len(tokens):
                for gate in {m[1] for m in moved}:
                    own = [m for m in moved if m[1] == gate]
                    weights[gate] += 0.15 * sum(np.array(m[0]) * m[3] for m in own) / (len(own) + 60)
                for span in {m[2] for m in moved}:
                    own = [m for m in moved if m[2] == span]
                    refine[span] += 1.5 * sum(m[3] for m in own) / (len(own) + 60)
    return cost


@pytest.mark.parametrize("held", [1 << 17, 12])
def test_lm_scores_equal_plain_ones(spark, monkeypatch, held):
    """Scores under any partitioning are those of dictionaries of whole contexts, with all tokens
    as words and with most of them spelled."""
    monkeypatch.setattr(lm_scoring, "WORDS", held)
    monkeypatch.setattr(lm_scoring, "WORD_BITS", (22, 22))  # hardly a slot is shared
    gen = random.Random(8)
    rows = [(i, f"alpha beta {sentence(EN + DE, 12)} x{gen.randrange(10**6)} gamma {gen.choice(EN)}") for i in range(40)]
    rows += [(50, "beta " + sentence(EN, 70) + " zürich zürich"), (51, ""), (52, "alpha beta " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.col("doc_id") % 5 != 2)
    texts = {i: lm_scoring.tokens_of(t) for i, t in rows}
    training = [t for i, t in texts.items() if i % 5 != 2]
    counts = Counter(t for x in training for t in x)
    models = [lm_scoring.train(df.repartition(n))[0] for n in (1, 7)]
    for a, b in ((m.weights, m.refine) for m in models), ((m.word_seen, m.byte_seen) for m in models):
        assert all(np.allclose(x, y, atol=1e-4) for x, y in zip(a, b))
    got = {r.doc_id: r.score for r in lm_scoring.score(df.repartition(7), F.col("learn")).collect()}
    for i in (2, 7, 50, 51, 52):
        assert got[i] == pytest.approx(-plain_nats(models[0], counts, training, texts[i]) / math.log(10), rel=2e-3)


def test_lm_bits_are_by_the_bytes_of_the_text(spark):
    rows = [(i, "the  und\n" * 5 + "é") for i in range(3)] + [(5, ""), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in lm_scoring.score(df, F.lit(True)).collect():
        size = len((dict(rows)[r.doc_id] or "").encode())
        assert r.bits_per_byte is None if not size else r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / size)


def test_lm_learns_from_all_texts_and_every_few_tokens(spark):
    """Long texts teach the starting weights like any other, however they are dealt out, and
    a document learns online well before 128 tokens."""
    long = " ".join(sentence(EN, 50) for _ in range(120))
    assert len(long) > 20_000
    df = spark.createDataFrame([(i, long) for i in range(2)] + [(9, "the of")], "doc_id long, text string").withColumn("learn", F.lit(True))
    models = [lm_scoring.train(df.repartition(n))[0] for n in (1, 3)]
    assert not np.allclose(models[0].weights, lm_scoring.start_weights())
    assert np.allclose(models[0].weights, models[1].weights) and np.allclose(models[0].refine, models[1].refine)
    model = models[0]
    same = [b"zzqx"] * 100
    batch = lm_scoring.Batch(model, [same])
    mixer = lm_scoring.Mixer(model.weights, model.refine, 1)
    fixed = lm_scoring.Mixer(model.weights, model.refine, 1)
    batch.costs(mixer)
    assert not np.allclose(mixer.w, fixed.w)


# ----------------------------------------------------- links, short and long texts


def test_every_link_form_joins_its_component(spark):
    """Every canonical and refresh tag of a page counts, and every relative form is resolved."""
    link = '<link rel="{}" href="{}">'
    forms = {
        "index2.html": "/a/b/index2.html", "./x": "/a/b/x", "../x": "/a/x", "../../../x": "/x", "../": "/a/", "..": "/a/", ".": "/a/b/", "?p=2": "/a/b/page?p=2",
        "/r/../s?u=http://q.org/": "/s?u=http://q.org/", "x?next=http://q.org/y": "/a/b/x?next=http://q.org/y",
    }
    pages = [(i, f"https://H{i}.net/a/b/page?old#f", link.format("canonical", form)) for i, form in enumerate(forms)]
    pages += [
        (20, "https://k.org/1", link.format("alternate canonical", "2")), (21, "https://k.org/1", "<link rel='icon' href='i'><LINK HREF=3 REL=canonical>"),
        (22, "https://k.org/1", link.format("canonical", "4") + link.format("canonical", "5")), (23, "https://k.org/1", '<meta http-equiv="refresh" content="0; url=6"><meta http-equiv=refresh content="0;url=7">'),
        (24, "https://k.org/1", link.format("canonical", "//m.org/8")), (25, "https://k.org/1", link.format("not-canonical", "9") + link.format("canonical", "mailto:x")), (26, "https://k.org", link.format("canonical", "t")), (27, "nothing", link.format("canonical", "t")),
    ]
    got = {(r.src, r.dst) for r in url_filter.page_links(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = {(f"https://H{i}.net/a/b/page?old#f", f"https://h{i}.net{full}") for i, full in enumerate(forms.values())}
    want |= {("https://k.org/1", f"https://k.org/{n}") for n in range(2, 8)} | {("https://k.org/1", "https://m.org/8"), ("https://k.org", "https://k.org/t")}
    assert got == want
    odd = [
        (1, "https://e.org/1", '<link title="a > b" rel="canonical" href="https://d.org/p?a=1&amp;b=2">'), (2, "https://e.org/1", """<link rel="canonical" href="https://d.org/it's">"""),
        (3, "https://e.org/1", "<link rel='canonical' href='&#47;x&#x3F;y&#228;&#x110000;'>"), (4, "https://e.org/1", '<base href="/b/c/"><base href="/no/"><link rel=canonical href=z>'),
        (5, "https://e.org/1", """<META HTTP-EQUIV='refresh' CONTENT="5; URL='q?a=1&amp;b=2'">"""), (6, "https://e.org/1", '<link rel=canonical href="w" title="open>'),
    ]
    got = {(r.src, r.dst) for r in url_filter.page_links(spark.createDataFrame(odd, "page_id long, url string, html string")).collect()}
    want = ["https://d.org/p?a=1&b=2", "https://d.org/it's", "https://e.org/x?yä&#x110000;", "https://e.org/b/c/z", "https://e.org/q?a=1&b=2", "https://e.org/w"]
    assert got == {("https://e.org/1", dst) for dst in want}
    rows = [(1, "https://n.net/es/x", link.format("canonical", "../to")), (2, "https://o.org/d/x", '<link rel="canonical" href="https://n.net/q"><link rel="shortcut canonical" href="../to">'), (3, "https://o.org/to", "")]
    verdict = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES, spark.createDataFrame([("https://n.net/to", "https://n.net/q")], "src string, dst string")).collect()}
    assert verdict == {1: "block", 2: "block", 3: "block"}


def test_language_id_learns_from_whole_texts(spark):
    rows = [(i, sentence(EN, 30), "en") for i in range(10)] + [(50 + i, sentence(DE, 30), "de") for i in range(10)]
    rows += [(100, "the " * 6000 + "quixotry " * 5, "en")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert "quixotry" in model.words


def test_toxicity_reads_every_word():
    """Words of no list have vectors too: other words give other scores, equal windows one."""
    model = toxicity.Model({"bad": 1}, {"<bad>": 1})
    clean = [[rng.choice(EN) for _ in range(8)] for _ in range(40)]
    model.params = toxicity.train(model, [*clean, *[[*c[:7], "bad"] for c in clean]], np.repeat([0.0, 1], 40), steps=30)
    got = toxicity.scorer(model)(["unlisted words stand here", "others do so elsewhere", "unlisted words stand here"])
    assert got[0] != got[1] and got[0] == got[2]
    assert len({model.inputs(w) for w in EN + DE}) == len(set(EN + DE))


def test_toxicity_score_is_the_highest_window_s(monkeypatch):
    """Against every window on its own, also where texts are cut into segments and lanes."""
    model = toxicity.Model({"bad": 1, "of": 2}, {"<bad>": 1})
    clean = [[rng.choice(EN) for _ in range(8)] for _ in range(40)]
    model.params = toxicity.train(model, [*clean, *[[*c[:7], "bad"] for c in clean]], np.repeat([0.0, 1], 40), steps=60)
    texts = [None, "", "bad", *[" ".join(rng.choices([*EN, *DE, "bad"], k=n)) for n in (5, 31, 32, 33, 64, 200, 31, 90)]]
    inputs = toxicity.Inputs(model)
    want, at = [], []
    for t in texts:
        words = (t or "").split()
        starts = toxicity.window_starts(len(words))
        ids, filled = np.zeros((len(starts), toxicity.WINDOW), int), np.array([len(words[a : a + toxicity.WINDOW]) for a in starts])
        for row, a, n in zip(ids, starts, filled):
            row[:n] = inputs.look_up(words[a : a + n])
        logits = toxicity.forward(model.params, toxicity.vectors(model.params, inputs.flat()), ids, filled)
        want.append(1 / (1 + math.exp(-logits.max())))
        at.append(logits)
    for segment, lanes in ((1 << 15, 1 << 11), (50, 7)):
        monkeypatch.setattr(toxicity, "SEGMENT", segment)
        monkeypatch.setattr(toxicity, "LANES", lanes)
        score = toxicity.scorer(model)
        assert score([*texts, texts[-1]]) == pytest.approx([*want, want[-1]], rel=1e-4)
        _, starts, _ = score.windows(texts)
        assert all(logits[a] >= logits.max() - 1e-4 for logits, a in zip(at, starts))


def test_toxicity_windows_hold_every_passage():
    """A passage of up to 29 words stands whole in a window, wherever it begins."""
    for n in (1, 31, 32, 33, 60, 200):
        starts = toxicity.window_starts(n)
        for a in range(n):
            assert any(s <= a and min(a + 29, n) <= s + toxicity.WINDOW for s in starts)
