"""Hash key, exact boundaries and ranks: brute force and partition invariance."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quarry.operators import sampling as X
from quarry.operators.keys import H, K, HashOrder, first_k, hash_rank, rank_by, with_hash_key


def py_hash(key: str, seed) -> int:
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:15], 16)


def frame(spark, n, parts=4):
    return spark.range(n).repartition(parts).select(F.col("id").alias("k"), (F.col("id") * 3 % 17).alias("v"))


def test_hash_matches_python(spark):
    rows = with_hash_key(frame(spark, 50), "k", 7).select("k", H).collect()
    for r in rows:
        assert r[H] == py_hash(str(r["k"]), 7)


@pytest.mark.parametrize("k", [0, 1, 2, 77, 499, 500, 600])
@pytest.mark.parametrize("narrow", [False, True])
def test_first_k_exact(spark, k, narrow):
    n = 500
    keyed = with_hash_key(frame(spark, n), "k", 3)
    # narrow=True: 16 fine buckets of ~31 rows > leaf 5, so the recursive narrowing runs
    order = HashOrder(keyed, fine_bits=4, coarse_bits=2, leaf_rows=5, fanout_bits=3) if narrow else HashOrder(keyed)
    got = sorted(r["k"] for r in first_k(keyed, order, k)[0].select("k").collect())
    brute = sorted(range(n), key=lambda i: (py_hash(str(i), 3), str(i)))[: min(k, n)]
    assert got == sorted(brute)


def test_boundaries_many_cuts_one_pass(spark):
    n = 700
    keyed = with_hash_key(frame(spark, n), "k", 11)
    order = HashOrder(keyed, fine_bits=6, coarse_bits=3)
    assert order.count() == n
    brute = sorted(range(n), key=lambda i: (py_hash(str(i), 11), str(i)))
    ks = [1, 350, 351, 699, 700, 701]
    bounds = order.boundaries(ks)
    for k in ks:
        if k > n:
            assert bounds[k] is None
        else:
            assert bounds[k].key == str(brute[k - 1])


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_split_partition_invariant(spark, parts):
    df = frame(spark, 2000, parts)
    train, valid = X.train_test_split(df, 0.25, key="k", seed=1)
    t = {r["k"] for r in train.select("k").collect()}
    v = {r["k"] for r in valid.select("k").collect()}
    assert len(t) == 1500 and len(v) == 500 and not (t & v)
    brute = sorted(range(2000), key=lambda i: (py_hash(str(i), 1), str(i)))
    assert t == set(brute[:1500])


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_sample_n_partition_invariant(spark, parts):
    got = {r["k"] for r in X.sample_n(frame(spark, 1000, parts), 37, "k", 42).collect()}
    brute = sorted(range(1000), key=lambda i: (py_hash(str(i), 42), str(i)))[:37]
    assert got == set(brute)


def test_sample_n_larger_than_rows_keeps_all(spark):
    assert X.sample_n(frame(spark, 10), 11, "k").count() == 10
    assert X.sample_capped(frame(spark, 10), 0, "k").count() == 10
    assert X.sample_n(frame(spark, 10), 0, "k").count() == 0


def test_sample_fraction_is_filter(spark):
    df = frame(spark, 5000)
    got = X.sample_fraction(df, 0.1, "k", 1).count()
    brute = sum(1 for i in range(5000) if py_hash(str(i), 1) < int(0.1 * (1 << 60)))
    assert got == brute
    plan = X.sample_fraction(df, 0.1, "k", 1)._jdf.queryExecution().executedPlan().toString()
    assert "Sample" not in plan


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_hash_rank(spark, parts):
    keyed = with_hash_key(frame(spark, 3000, parts), "k", 5)
    rows = hash_rank(keyed, "r", rows_per_bucket=100).select("k", "r").collect()
    brute = sorted(range(3000), key=lambda i: (py_hash(str(i), 5), str(i)))
    assert {r["k"]: r["r"] for r in rows} == {k: i for i, k in enumerate(brute)}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_rank_by(spark, parts):
    df = frame(spark, 1000, parts)
    rows = rank_by(df, [F.col("v").desc(), F.col("k")], "r", num_partitions=parts).collect()
    brute = sorted(range(1000), key=lambda i: (-(i * 3 % 17), i))
    assert {r["k"]: r["r"] for r in rows} == {k: i for i, k in enumerate(brute)}


def test_sequential_cutoffs():
    assert X.sequential_cutoffs(15000) == (12000, 13500)
    assert X.sequential_cutoffs(9) == (7, 7)


def test_sequential_split(spark):
    parts = X.sequential_split(frame(spark, 105), ["k"])
    assert [parts[s].count() for s in ("train", "validation", "test")] == [84, 10, 11]
    assert max(r["k"] for r in parts["train"].collect()) == 83


def test_one_key_for_all_rows(spark):
    """A cut inside a key that all rows share names how many of them it takes."""
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id"))
    keyed = with_hash_key(df, "k", 1)
    order = HashOrder(keyed, fine_bits=8, leaf_rows=10, fanout_bits=30)
    assert order.boundary(50).taken == 50
    first, rest = first_k(keyed, order, 50)
    assert first.count() == 50 and rest.count() == 150


def test_key_text_columns(spark):
    df = spark.createDataFrame([(1, "a", None)], "x long, y string, z string")
    r = with_hash_key(df, ["x", "y", "z"], 9).select(K, H).collect()[0]
    assert r[K] == "1|a|\\N" and r[H] == py_hash("1|a|\\N", 9)


def test_head_large_path(spark, monkeypatch):
    df = frame(spark, 300, 3)
    want = sorted(r["k"] for r in X.head(df, 50, [F.col("v").desc(), "k"]).collect())
    monkeypatch.setattr(X, "TOP_K_ROWS", 10)
    got = sorted(r["k"] for r in X.head(df, 50, [F.col("v").desc(), "k"]).collect())
    assert got == want and len(got) == 50


def test_checkpointed_fine_counts_path(spark):
    n = 800
    keyed = with_hash_key(frame(spark, n), "k", 23)
    order = HashOrder(keyed, fine_bits=16, coarse_bits=6)  # > 2^14 buckets: checkpointed table + coarse view
    assert order.fine_bits > HashOrder.DIRECT_BITS and order.count() == n
    brute = sorted(range(n), key=lambda i: (py_hash(str(i), 23), str(i)))
    bounds = order.boundaries([1, 200, 599, 600, 800, 801])
    assert bounds[801] is None
    for k in (1, 200, 599, 600, 800):
        assert bounds[k].key == str(brute[k - 1])


def test_cuts_are_exact_on_repeated_and_null_keys(spark):
    rows = [(i % 10 if i % 7 else None, "x" if i % 3 else None, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, v int")
    t, v = X.train_test_split(df, 0.25, key=["a", "b"], seed=1)
    assert (t.count(), v.count()) == (750, 250)
    assert sorted(r["v"] for r in t.union(v).collect()) == list(range(1000))
    same = spark.createDataFrame([(1, 2)] * 40, "a int, v int")
    t, v = X.permutation_split(same, 0.2, key="a")
    assert (t.count(), v.count()) == (32, 8)
    assert X.sample_n(df, 123, key="a").count() == 123
    parts = X.sequential_split_hashed(with_hash_key(df, "a", 1))
    assert {k: p.count() for k, p in parts.items()} == {"train": 800, "validation": 100, "test": 100}
    assert "_qt" not in parts["train"].columns


def test_null_parts_are_marked(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert with_hash_key(df, ["x", "y"], 1).select(K).distinct().count() == 2
