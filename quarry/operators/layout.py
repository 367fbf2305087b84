"""Input layout: spread narrow, CPU-heavy work over the cluster's cores.

A scan yields one task per file split; a table stored as a few large
single-row-group files therefore runs all row-local work (tokenising,
n-gram expansion, gradient sums) in a handful of tasks until the first
shuffle.  ``spread`` adds one hash exchange on the row key only when the
input has fewer partitions than the cluster's default parallelism; large
inputs already have enough splits and pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def _has_exchange(df: DataFrame) -> bool:
    """Whether the physical plan already shuffles or broadcasts (read from the plan, nothing runs)."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def spread(df: DataFrame, key=None, min_partitions: int | None = None) -> DataFrame:
    # Asking an adaptive plan with exchanges for its partitions would run its
    # shuffle stages; such an input is already shuffle-partitioned anyway.
    if _has_exchange(df):
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    if key is None:
        return df.repartition(target)
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    return df.repartition(target, *keys)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's reliable checkpoint folder and read it back.

    Used before exact splits of expensive inputs: the cut-off search scans its
    input more than once (key columns only) and every split side scans it
    again, so a join- or tokenisation-derived input is computed once instead
    of once per pass.  A reliable checkpoint (not a local one) survives the
    loss of the executors that wrote it.
    """
    from quarry.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``materialize`` as compressed Parquet: for large tables of numbers and words, a fraction
    of the bytes of a checkpoint."""
    from quarry.sources.readers import scratch_dir

    path = scratch_dir(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
