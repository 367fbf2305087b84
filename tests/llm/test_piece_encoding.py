"""Encoding by backtracking against the library."""

import hashlib
import random

import pytest
import sentencepiece

from quarry.llm import piece_encoding as P
from quarry.llm.queries import pieces_path


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=pieces_path())


def texts(sp, n, seed=1):
    rng = random.Random(seed)
    pieces = [sp.id_to_piece(i) for i in range(3, sp.get_piece_size())]
    make = [
        lambda: " " * rng.randrange(70) + rng.choice(["", "x", "hello", "\n", "▁"]) + " " * rng.randrange(40),
        lambda: "".join(rng.choice(" ▁ab\n\t") for _ in range(rng.randrange(60))),
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(30))),
        lambda: "".join(rng.choice(pieces).replace("▁", " ") for _ in range(rng.randrange(30))),
        lambda: "".join(chr(rng.choice([rng.randrange(0, 127), rng.randrange(0x400, 0x4FF), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F600, 0x1F650), 0xFFFD, 0x10FFFF])) for _ in range(rng.randrange(50))),
        lambda: rng.choice("aehilonrst=-*/#.") * rng.randrange(300),
        lambda: "".join(rng.choice("aeinrst ") for _ in range(rng.randrange(80))),
    ]
    return [rng.choice(make)() for _ in range(n)]


FIXED = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "<s></s><unk>", "<0x0A>", "\n", "\0", "½①²", "é é", "don't", "x" * 5000, " " * 3000, "ａｂｃ", "🙂🙃", "the  of\n\nand"]


def test_ids_are_the_library_s(sp):
    own = P.Encoder(sp)
    assert own.spaced and own.plain
    for t in FIXED + texts(sp, 6000):
        assert own.encode(t) == sp.encode(t, add_eos=True), repr(t)


def test_backtracks_and_agrees_by_merging(sp):
    v = P.Vocabulary(sp)
    given_back = 0
    for t in texts(sp, 1500, seed=2):
        for part in v.cuts(t):
            if part:
                got = v.pieces(part)
                assert got == v.merged(part)[0]
                for a, b in zip(got, got[1:]):
                    assert v.agree(a, b) and v.merged(a + b)[0] == [a, b]
                greedy, at = [], 0
                while at < len(part):
                    n = max((k for k in range(1, len(part) - at + 1) if part[at : at + k] in v.score), default=1)
                    greedy.append(part[at : at + n])
                    at += n
                given_back += greedy != got
    assert given_back > 100  # longest matches alone would be wrong
    pieces = random.Random(3).choices([p for p in v.score if v.log(p)], k=4000)
    for a, b in zip(pieces, pieces[1:]):
        assert v.agree(a, b) == (v.merged(a + b)[0] == [a, b])


def test_caches_start_anew(sp, monkeypatch):
    monkeypatch.setattr(P, "CACHE_ENTRIES", 20)
    own = P.Encoder(sp)
    for t in texts(sp, 300, seed=4):
        assert own.encode(t) == sp.encode(t, add_eos=True)
        assert len(own.words) < 500


def test_table(spark, sp):
    rows = [(i, t, "clash", 1) for i, t in enumerate([None, *FIXED, *texts(sp, 200, seed=5)])] + [(3, " ", "again", 2), (3, "other", None, 2), (None, "null id", None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = sorted((tuple(r) for r in P.digests(df.repartition(4), pieces_path()).collect()), key=str)
    want = []
    for i, t, _, _ in rows:
        ids = sp.encode(t or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    full = {r["doc_id"]: r for r in P.encode(df.where("doc_id < 3"), pieces_path()).collect()}
    assert full[0]["ids"] == [sp.eos_id()] and full[2]["decoded"] == " "
    assert P.digests(df.limit(0), pieces_path()).collect() == []


def test_long_text(spark, sp):
    rng = random.Random(6)
    text = "".join(rng.choice("aeinrst") for _ in range(200_000))
    (row,) = P.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), pieces_path()).collect()
    assert row["ids"] == sp.encode(text, add_eos=True) and row["decoded"] == text
