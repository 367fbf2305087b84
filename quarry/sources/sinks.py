"""Writers: split export, reports, push results and model records."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUSH_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("plugin", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("value", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

MODEL_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("artifact_path", T.StringType()),
    ]
)


def run_id_of(path: str) -> str:
    """Last path component (trailing slashes ignored)."""
    return path.rstrip("/").split("/")[-1]


def export_splits(df: DataFrame, root: str, project: str, run_id: str, split_col: str = "split") -> str:
    """Write ``datasets/<project>/<run_id>/split=<name>/`` in one distributed write.

    The URI scheme of ``root`` selects the filesystem (local, HDFS, object store).
    """
    uri = f"{root.rstrip('/')}/datasets/{project}/{run_id}"
    df.write.mode("overwrite").partitionBy(split_col).parquet(uri)
    return uri


def write_report(spark: SparkSession, title: str, metrics: DataFrame, root: str, digits: int = 4) -> DataFrame:
    """``(title, metric, value)`` rows with values rounded; written as JSON lines."""
    rep = metrics.select(F.lit(title).alias("title"), "metric", F.round("value", digits).alias("value"))
    rep.coalesce(1).write.mode("overwrite").json(root)
    return rep


@dataclass
class PushItem:
    name: str
    plugin: str
    action: object  # callable returning the pushed value (e.g. a path)


def push_all(spark: SparkSession, items: list[PushItem]) -> DataFrame:
    """Run every push; one result row each, errors captured per item."""
    rows = []
    for it in items:
        try:
            value = it.action()
            rows.append((it.name, it.plugin, True, None if value is None else str(value), None))
        except Exception as e:  # noqa: BLE001 - the row records the failure
            rows.append((it.name, it.plugin, False, None, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, PUSH_SCHEMA)


def register_model(spark: SparkSession, record: dict, root: str) -> DataFrame:
    """Append one model record row to a parquet table and return it."""
    row = (
        record["name"],
        record.get("description", ""),
        record.get("kind", "REGRESSION"),
        {str(k): str(v) for k, v in record.get("labels", {}).items()},
        {str(k): float(v) for k, v in record.get("metrics", {}).items()},
        {str(k): json.dumps(v) if not isinstance(v, str) else v for k, v in record.get("params", {}).items()},
        record.get("artifact_path"),
    )
    df = spark.createDataFrame([row], MODEL_RECORD_SCHEMA)
    df.write.mode("append").parquet(root)
    return df


def save_pipeline_model(model, path: str) -> str:
    """Persist a fitted ``pyspark.ml`` pipeline (preprocessing included)."""
    model.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def save_mlp(spark: SparkSession, model, path: str) -> str:
    """Store MLP weights and scaling as a one-row parquet table."""
    row = {
        "features": model.features,
        "label": model.label,
        "sizes": model.sizes,
        "weights": [w.ravel().tolist() for w in model.weights],
        "mean": model.mean.tolist(),
        "std": model.std.tolist(),
        "y_mean": float(model.y_mean),
        "y_std": float(model.y_std),
    }
    schema = (
        "features array<string>, label string, sizes array<int>, weights array<array<double>>, "
        "mean array<double>, std array<double>, y_mean double, y_std double"
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_mlp(spark: SparkSession, path: str):
    import numpy as np

    from quarry.operators.mlp import MLPModel, init_weights

    r = spark.read.parquet(path).collect()[0]
    shapes = init_weights(list(r["sizes"]))
    weights = [np.array(w).reshape(s.shape) for w, s in zip(r["weights"], shapes)]
    return MLPModel(list(r["features"]), r["label"], list(r["sizes"]), weights, np.array(r["mean"]), np.array(r["std"]),
                    r["y_mean"], r["y_std"])
