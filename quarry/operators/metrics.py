"""Whole-dataset statistics and evaluation metrics as single aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.fixed import METRIC_DIGITS


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def dataset_stats(df: DataFrame, order_cols, ids: str = "input_ids") -> DataFrame:
    """One row: rows, column names, first row's length, min/max/avg length.

    "First" is by ``order_cols`` (Spark rows have no position).  On empty
    input only ``num_samples`` (0) is set.
    """
    if isinstance(order_cols, (str, Column)):
        order_cols = [order_cols]
    order = F.struct(*[_c(c) for c in order_cols])
    n = F.count(F.lit(1))
    has = n > 0
    return df.agg(
        n.alias("num_samples"),
        F.when(has, F.lit(",".join(df.columns))).alias("columns"),
        F.min_by(F.size(ids), order).cast("bigint").alias("sample_input_ids_length"),
        F.min(F.size(ids)).cast("bigint").alias("min_length"),
        F.max(F.size(ids)).cast("bigint").alias("max_length"),
        F.avg(F.size(ids)).alias("avg_length"),
    )


def step_counts(steps: dict[str, DataFrame], labelled: DataFrame | None = None,
                splits: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """Row count of each named step as rows ``(step, n_rows)``; a frame with a ``split``
    column adds one row per split from a single pass."""
    out = None
    if labelled is not None:
        none = labelled.sparkSession.createDataFrame([(s, 0) for s in splits], "step string, n_rows bigint")
        each = labelled.groupBy(F.col("split").alias("step")).agg(F.count(F.lit(1)).alias("n_rows"))
        out = each.unionByName(none).groupBy("step").agg(F.max("n_rows").alias("n_rows"))
    for name, df in steps.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("step"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def confusion(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """tp / tn / fp / fn counts for a binary label, in one aggregate."""
    yy, pp = _c(y) == 1, _c(yhat) == 1
    aggs = [
        F.count_if(yy & pp).alias("tp"),
        F.count_if(~yy & ~pp).alias("tn"),
        F.count_if(~yy & pp).alias("fp"),
        F.count_if(yy & ~pp).alias("fn"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def mcc_expr(tp="tp", tn="tn", fp="fp", fn="fn") -> Column:
    """Matthews correlation from counts; 0.0 when the denominator is 0.

    Counts are cast to double first: the product of four bigint counts
    overflows (and raises under ANSI) on large data.
    """
    tp, tn, fp, fn = (_c(x).cast("double") for x in (tp, tn, fp, fn))
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return F.when(den == 0, F.lit(0.0)).otherwise((tp * tn - fp * fn) / den)


def mcc(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    conf = confusion(df, y, yhat, by)
    return conf.withColumn("mcc", mcc_expr())


def mse(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """Mean squared error (per group); partial sums combine map-side."""
    err = F.avg(F.pow(_c(yhat).cast("double") - _c(y).cast("double"), 2)).alias("mse")
    n = F.count(F.lit(1)).alias("n_rows")
    return df.groupBy(*by).agg(err, n) if by else df.agg(err, n)


def eval_summary(df: DataFrame, perplexity: str = "perplexity", score: str = "generation_score") -> DataFrame:
    """Count, mean and population std of per-row perplexity and score.

    Empty input gives ``inf`` mean perplexity and ``0.0`` for the rest;
    rows whose score is NULL (not scored) do not count for the score.
    """
    return df.agg(
        F.count(_c(perplexity)).alias("num_samples_evaluated"),
        F.coalesce(F.avg(perplexity), F.lit(float("inf"))).alias("average_perplexity"),
        F.coalesce(F.stddev_pop(perplexity), F.lit(0.0)).alias("perplexity_std"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("average_generation_score"),
        F.coalesce(F.stddev_pop(score), F.lit(0.0)).alias("generation_score_std"),
    )


def round_metrics(df: DataFrame, value: str = "value", digits: int = METRIC_DIGITS) -> DataFrame:
    """Round metric values half-up to ``digits`` decimals (NULL stays NULL)."""
    return df.withColumn(value, F.round(_c(value), digits))


def metrics_long(row: DataFrame) -> DataFrame:
    """One-row wide metric frame -> long ``(metric, value)`` rows."""
    cols = row.columns
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])).alias("m")
    ).select("m.*")


def best_run(df: DataFrame, metric: str, mode: str = "min", by: list[str] | None = None, tie: str = "epoch") -> DataFrame:
    """Best row per group by ``metric`` (``min`` or ``max``); ties -> smallest ``tie``."""
    m = _c(metric) if mode == "min" else -_c(metric)
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(m, F.col(tie)))
    agg = df.groupBy(*by).agg(row.alias("_best")) if by else df.agg(row.alias("_best"))
    return agg.select("_best.*")
