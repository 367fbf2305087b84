"""Arrow batch functions: cuts, state, declared schema."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import batches as B


def test_cuts_keep_order_and_bounds():
    texts = ["x" * n for n in (5, 5000, 1, 1, 90_000, 3, 700, 700, 700)]
    batch = pa.RecordBatch.from_pydict({"i": list(range(9)), "t": texts})
    parts = list(B.cut(batch, 4, 10_000))
    assert [v for p in parts for v in p.column("i").to_pylist()] == list(range(9))
    assert all(p.num_rows <= 4 and (p.nbytes <= 10_000 or p.num_rows == 1) for p in parts)
    assert [p.num_rows for p in B.cut(batch, 100, 1 << 30)] == [9]


def test_state_is_set_up_once_per_worker_and_stage(spark):
    def setup():
        return {"pid": os.getpid(), "calls": 0}

    def fn(batch, state):
        state["calls"] += 1
        n = batch.num_rows
        return pa.RecordBatch.from_pydict({"pid": pa.array([state["pid"]] * n, pa.int64()), "call": pa.array([state["calls"]] * n, pa.int64()), "kept": pa.array([len(B._STATES)] * n, pa.int32())})

    df = spark.range(0, 400, 1, 8)
    for _ in range(2):  # a second run is another stage: its states begin anew
        rows = B.map_batches(df, fn, "pid long, call long, kept int", setup, max_rows=10).collect()
        assert len(rows) == 400 and {r["kept"] for r in rows} == {1}
        for pid in {r["pid"] for r in rows}:
            calls = sorted(r["call"] for r in rows if r["pid"] == pid)
            assert calls[0] == 1 and len(calls) == 10 * calls[-1]  # counted over tasks, batch by batch


def test_schema_is_checked(spark):
    df = spark.range(3)
    with pytest.raises(Exception, match="declared"):
        B.map_batches(df, lambda b, s: pa.RecordBatch.from_pydict({"id": pa.array([1.5] * b.num_rows)}), "id long").collect()
    with pytest.raises(Exception, match="declared"):
        B.map_batches(df, lambda b, s: pa.RecordBatch.from_pydict({"other": pa.array([1] * b.num_rows, pa.int64())}), "id long").collect()
    assert B.map_batches(df, lambda b, s: None, "id long").count() == 0
    assert B.map_batches(df.limit(0), lambda b, s: b, df.schema).count() == 0


def test_in_row_lookup_equals_the_join(spark, monkeypatch):
    rows = [("a", "The cat </s> sat"), ("b", ""), ("c", None), ("d", "   "), ("e", "the the unknown-ß " * 300), ("f", "cat")]
    df = spark.createDataFrame(rows, "id string, text string")
    vocab = TX.build_vocab(df.where("id <> 'e'"), "text", 5)
    for make in (lambda: TX.tokenise(df, vocab, 7, "id"), lambda: TX.tokenise(df, vocab, None, "id"), lambda: TX.tokenise_padded(df, vocab, 6, "id")):
        got = sorted(make().collect())
        with monkeypatch.context() as m:
            m.setattr(TX, "IN_ROW_TOKENS", 0)
            assert got == sorted(make().collect())


def test_token_queries_keep_ids_only(spark, monkeypatch, tmp_path):
    """Mask and labels follow from the ids: neither is numbered, shuffled or checkpointed with them."""
    from quarry.operators import sampling as X
    from quarry.plans import queries as Q

    spark.createDataFrame([(i, f"a b{i} c d e") for i in range(20)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    numbered, kept = [], []
    renumber, keep = X.renumber, Q.materialize
    monkeypatch.setattr(X, "renumber", lambda df, *a, **k: numbered.append(df.columns) or renumber(df, *a, **k))
    monkeypatch.setattr(Q, "materialize", lambda df: kept.append(df.columns) or keep(df))
    padded = Q.q_pad_batches(spark, str(tmp_path)).collect()
    assert len(padded) == 20 and all(len(r["labels"].split(",")) == len(r["input_ids"].split(",")) == 8 for r in padded)
    assert Q.q_evaluate_lm_head(spark, str(tmp_path)).first()["num_samples_evaluated"] == 20
    assert numbered == kept == [["doc_id", "input_ids"]]
