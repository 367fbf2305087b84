"""Checkpoints of a fit: tables published step by step, best and last kept, resumable.

A step's tables are written to a folder of their own; only then one row that names the folder
is appended to the manifest.  Spark commits that append as a whole, so a driver lost in
between leaves a folder that nothing names, never half a checkpoint.  ``prune`` removes the
folders of steps that are neither the last nor the best, and unnamed ones of published steps'
earlier attempts are never read.

Each row carries the fit's settings; a store that holds another fit's steps is refused.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quarry.sources.readers import is_missing_path

MANIFEST = "step int, path string, metric double, settings string"


@dataclass(frozen=True)
class CheckpointStore:
    root: str
    settings: str = ""
    mode: str = "min"  # which metric is best

    def steps(self, spark: SparkSession) -> DataFrame:
        """Published steps, one row each (a step that was published twice counts by its first path)."""
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            return spark.createDataFrame([], MANIFEST)
        return rows.groupBy("step").agg(F.min_by(F.struct("path", "metric", "settings"), "path").alias("r")).select("step", "r.*")

    def publish(self, spark: SparkSession, step: int, tables: dict[str, DataFrame], metric: float) -> str:
        path = f"{self.root}/step-{step}-{uuid.uuid4().hex[:12]}"
        for name, table in tables.items():
            table.write.parquet(f"{path}/{name}")
        spark.createDataFrame([(step, path, float(metric), self.settings)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return path

    def _rows(self, spark: SparkSession) -> list[Row]:
        rows = self.steps(spark).orderBy("step").collect()  # one a step
        if any(r["settings"] != self.settings for r in rows):
            raise ValueError(f"{self.root} holds the steps of a fit with other settings")
        return rows

    def last(self, spark: SparkSession) -> Row | None:
        rows = self._rows(spark)
        return rows[-1] if rows else None

    def best(self, spark: SparkSession) -> Row | None:
        """The step with the best metric, the earliest of equals."""
        rows = self._rows(spark)
        return min(rows, key=lambda r: (r["metric"] if self.mode == "min" else -r["metric"], r["step"])) if rows else None

    def load(self, spark: SparkSession, row: Row, name: str) -> DataFrame:
        return spark.read.parquet(f"{row['path']}/{name}")

    def prune(self, spark: SparkSession) -> list[int]:
        """Remove the tables of all steps but the last and the best; their rows stay.  Returns the steps kept."""
        rows = self._rows(spark)
        kept = {r["step"] for r in (self.last(spark), self.best(spark)) if r}
        for r in rows:
            if r["step"] not in kept:
                path = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return sorted(kept)
