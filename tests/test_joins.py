"""Hot/cold joins give the same rows as a plain join."""

from pyspark.sql import functions as F

from quarry.operators import indexing as A
from quarry.operators import joins as J
from quarry.operators import lm as LM
from quarry.functions import text as TX


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_hot_cold_join_equals_plain(spark):
    big = spark.createDataFrame([(i % 3 if i < 60 else i, i) for i in range(100)], "k long, v long")
    table = spark.createDataFrame([(k, k * 10) for k in range(0, 100, 2)], "k long, w long")
    hot = table.where("k = 0")
    for how in ("left", "inner"):
        assert _rows(J.hot_cold_join(big, table, ["k"], hot, how)) == _rows(big.join(table, "k", how))


def test_frequent_keys_bound(spark):
    df = spark.createDataFrame([(0,)] * 50 + [(i,) for i in range(1, 51)], "k long")
    keys = {r["k"] for r in J.frequent_keys(df, ["k"], share=10).collect()}
    assert keys == {0}


def test_apply_index_large_path(spark, monkeypatch):
    df = spark.createDataFrame([(1 if i < 40 else i, i) for i in range(100)], "user_id long, x long")
    idx = A.dense_index(df, "user_id", "user_idx")
    want = _rows(A.apply_index(df, idx, "user_id"))
    monkeypatch.setattr(A, "BROADCAST_ROWS", 0)
    assert _rows(A.apply_index(df, idx, "user_id")) == want


def test_lm_and_tokens_large_path(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, "the the cat " + ("sat" if i % 2 else "ran") + " the end") for i in range(30)], "k long, text string"
    )
    lm = LM.fit_ngram_lm(docs, "k", "text", 2)
    vocab = TX.build_vocab(docs, "text")
    want_p = _rows(LM.perplexity(docs, lm, "k"))
    want_t = _rows(TX.tokenise(docs, vocab, 5, key="k"))
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(TX, "IN_ROW_TOKENS", 0)
    monkeypatch.setattr(TX, "HOT_VOCAB_IDS", 6)
    got_p = _rows(LM.perplexity(docs, lm, "k"))
    assert len(got_p) == len(want_p)
    for a, b in zip(got_p, want_p):
        assert a[0] == b[0] and a[1] == b[1] and abs(a[2] - b[2]) < 1e-9
    assert _rows(TX.tokenise(docs, vocab, 5, key="k")) == want_t


def test_spread(spark):
    from quarry.operators.layout import spread

    one = spark.range(100).coalesce(1)
    assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    shuffled = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    assert spread(shuffled, "k") is shuffled


def test_large_index_reads_the_rows_once(spark, monkeypatch):
    df = spark.createDataFrame([(1 if i < 40 else i, i) for i in range(100)], "user_id long, x long")
    idx = A.dense_index(df, "user_id", "user_idx")
    monkeypatch.setattr(A, "BROADCAST_ROWS", 0)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    assert A.apply_index(df.mapInArrow(counted, df.schema), idx, "user_id").count() == 100
    assert reads.value == 100
