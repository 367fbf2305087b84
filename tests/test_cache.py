"""The cache that fills itself: publication, damage, versions, races."""

import pytest

from quarry.sources.cache import SourceCache, fingerprint


def counted(spark, calls, n=50):
    def load(s):
        calls.append(1)
        return s.range(n).selectExpr("id", "cast(id as string) as t", "if(id % 3 = 0, null, id * 0.5) as x")

    return load


def remove(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def test_second_read_is_the_cache_s(spark, tmp_path):
    calls, cache = [], SourceCache(str(tmp_path / "c"))
    load = counted(spark, calls)
    first, second = cache.read(spark, "a", load), cache.read(spark, "a", load)
    assert len(calls) == 1 and sorted(first.collect()) == sorted(second.collect()) == sorted(load(spark).collect())
    assert first.dtypes == load(spark).dtypes
    assert all(str(tmp_path) in f for f in second.inputFiles()) and set(first.inputFiles()) == set(second.inputFiles())


def test_damaged_and_unpublished_copies_fall_through(spark, tmp_path):
    calls, cache = [], SourceCache(str(tmp_path / "c"))
    load = counted(spark, calls)
    first = cache.read(spark, "a", load)
    remove(spark, first.inputFiles()[0])
    assert cache.cached(spark, "a") is None
    again = cache.read(spark, "a", load)
    assert len(calls) == 2 and fingerprint(again) == fingerprint(load(spark))
    remove(spark, again.inputFiles()[0].rsplit("/", 1)[0])  # the whole folder
    assert cache.read(spark, "a", load).count() == 50
    load(spark).write.parquet(f"{cache.root}/b-lost")  # written by a reader that died before it published
    assert cache.cached(spark, "b") is None


def test_changed_content_is_found_by_verification(spark, tmp_path):
    calls, cache = [], SourceCache(str(tmp_path / "c"))
    cache.read(spark, "a", counted(spark, calls))
    row = cache.copies(spark, "a")[0]
    other = SourceCache(cache.root)
    object.__setattr__(other, "copies", lambda *a: [type("R", (dict,), {})(row.asDict() | {"checksum": "1"})])
    assert other.cached(spark, "a") is not None and other.cached(spark, "a", verify=True) is None
    assert cache.cached(spark, "a", verify=True) is not None


def test_versions_and_racing_readers(spark, tmp_path):
    calls, cache = [], SourceCache(str(tmp_path / "c"))
    assert cache.read(spark, "a", counted(spark, calls, 5), version="1").count() == 5
    assert cache.read(spark, "a", counted(spark, calls, 7), version="2").count() == 7
    assert cache.read(spark, "a", counted(spark, calls, 9), version="1").count() == 5 and len(calls) == 2
    for _ in range(2):  # both found nothing and published
        cache.publish(spark, "b", spark.range(3))
    assert len(cache.copies(spark, "b")) == 2
    assert {tuple(sorted(cache.cached(spark, "b").inputFiles())) for _ in range(3)} == {tuple(sorted(cache.cached(spark, "b").inputFiles()))}


def test_empty_source_and_failing_source(spark, tmp_path):
    cache = SourceCache(str(tmp_path / "c"))
    assert cache.read(spark, "none", lambda s: s.range(0)).count() == 0

    def broken(s):
        raise FileNotFoundError("no source")

    with pytest.raises(FileNotFoundError):
        cache.read(spark, "broken", broken)
    assert cache.copies(spark, "broken") == []
