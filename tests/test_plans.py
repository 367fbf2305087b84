"""Physical-plan properties the design relies on (checked with explain, nothing heavy runs)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.functions import text as TX
from quarry.operators import sampling as X
from quarry.plans import queries as Q


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_prunes_scan(spark):
    p = plan(Q.q_select_rename_cast(spark, SF_SMALL))
    assert "ReadSchema" in p
    for unused in ("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey"):
        assert unused not in p


def test_fraction_sample_is_a_narrow_filter(spark):
    p = plan(X.sample_fraction(Q.table(spark, SF_SMALL, "documents"), 0.1, "doc_id"))
    assert "Exchange" not in p and "Sample" not in p and "Filter" in p


def test_labelled_split_scans_once(spark):
    p = plan(Q.q_split_summary(spark, SF_SMALL))
    assert "Union" not in p and p.count("FileScan parquet") == 1


def test_bounded_vocabulary_is_broadcast(spark, monkeypatch):
    docs = Q.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    vocab = TX.build_vocab(docs, "text", 1000)
    p = plan(TX.tokenise(docs, vocab, 32, key="doc_id"))
    assert "MapInArrow" in p and "Join" not in p  # looked up in the row
    assert p.count("Exchange") == p.count("REPARTITION_BY_NUM") <= 1  # but for spreading a file of one split
    monkeypatch.setattr(TX, "IN_ROW_TOKENS", 0)
    p = plan(TX.tokenise(docs, vocab, 32, key="doc_id"))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_pairs_have_no_window(spark):
    p = plan(Q.pairs_with_context(spark, SF_SMALL))
    assert "Window" not in p


def test_spread_only_when_narrow(spark):
    docs = Q.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    from quarry.operators.layout import spread

    assert "REPARTITION_BY_NUM" in plan(spread(docs, "doc_id"))  # one-split file -> spread
    grouped = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    assert spread(grouped, "doc_id") is grouped
