import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import columns as P


def test_parse_columns_no_trim():
    assert P.parse_columns("a, b,c") == ["a", " b", "c"]


def test_cast_float_ansi(spark):
    df = spark.createDataFrame([("1.5", "x")], "a string, b string")
    assert P.cast_float(df, ["a"]).schema["a"].dataType == T.FloatType()
    with pytest.raises(Exception):
        P.cast_float(df, ["b"]).collect()
    assert P.cast_float(df, ["b"], safe=True).collect()[0]["b"] is None


def test_drop_if_present_and_label(spark):
    df = spark.createDataFrame([(1, 2.0, "u", 3.0)], "a int, b double, uuid string, y double")
    out = P.drop_if_present(df)
    assert P.infer_label(out) == (["a", "b"], "y")


def test_normalise_is_float(spark):
    df = spark.createDataFrame([(1,), (3,), (5,)], "r long")
    out = P.normalise(df, "r", 1.0, 5.0, "n")
    assert out.schema["n"].dataType == T.FloatType()
    assert [r["n"] for r in out.orderBy("r").collect()] == [0.0, 0.5, 1.0]


@pytest.mark.parametrize("length,kept", [(9, False), (10, True), (16, True), (17, False)])
def test_filter_length_inclusive(spark, length, kept):
    df = spark.createDataFrame([(list(range(length)),)], "input_ids array<bigint>")
    assert (P.filter_length(df, "input_ids", 10, 16).count() == 1) == kept


def test_assemble(spark):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double")
    out = P.assemble(df, ["a", "b"])
    assert out.schema["features"].dataType == T.ArrayType(T.FloatType())
    assert out.collect()[0]["features"] == [1.0, 2.5]


def test_check_contract(spark):
    df = spark.createDataFrame([([1, 2], [1.0]), ([1], [1.0])], "ids array<bigint>, logits array<double>")
    spec = [
        P.ColumnSpec("ids", T.LongType(), 2),
        P.ColumnSpec("logits", T.FloatType(), 2),
        P.ColumnSpec("mask", T.LongType(), 2),
    ]
    got = {(r["column"], r["problem"], r["n_rows"]) for r in P.check_contract(df, spec).collect()}
    assert ("ids", "length != 2", 1) in got
    assert ("mask", "missing", None) in got
    assert ("logits", "length != 2", 2) in got
    assert any(c == "logits" and p.startswith("type") for c, p, _ in got)
