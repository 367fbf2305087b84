"""A cache of a source that fills itself.

The first read writes the source to a folder of its own and then appends one manifest row
that names it, with the files' lengths, the number of rows and an order-free checksum of the
content.  Spark commits that row as a whole, so a reader sees a finished copy or none, and
two readers that fill the cache at once publish two copies of which all later readers
take the same one.  A copy is used only while every file that the row names is there in its
length (looked up without reading them); otherwise the source is read and published anew.
``verify`` also compares the content.

A copy belongs to a ``version`` of the source (a date, a digest, whatever the caller knows);
copies of other versions are passed over.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.readers import is_missing_path

log = logging.getLogger(__name__)
MANIFEST = "name string, version string, path string, schema string, rows long, checksum string, files map<string,bigint>"


def fingerprint(df: DataFrame) -> tuple[int, str]:
    """Number of rows and an order-free checksum of their content, in one pass."""
    each = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0)
    r = df.agg(F.count("*").alias("n"), F.sum(each.cast("decimal(38,0)")).alias("s")).first()
    return r["n"], str(r["s"] or 0)


@dataclass(frozen=True)
class SourceCache:
    root: str

    def _files(self, spark: SparkSession, path: str) -> dict[str, int]:
        """Data files of a copy and their lengths; their content is not read."""
        try:
            found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length").collect()  # a copy's files
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            return {}
        return {r["path"].rsplit("/", 1)[-1]: r["length"] for r in found}

    def copies(self, spark: SparkSession, name: str, version: str = "") -> list[Row]:
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            return []
        return rows.where((F.col("name") == name) & (F.col("version") == version)).orderBy("path").collect()

    def cached(self, spark: SparkSession, name: str, version: str = "", verify: bool = False) -> DataFrame | None:
        """The first whole copy, if there is any."""
        for r in self.copies(spark, name, version):
            if self._files(spark, r["path"]) != r["files"]:
                log.warning("the cached copy %s of %s is damaged", r["path"], name)
                continue
            df = spark.read.schema(T.StructType.fromJson(json.loads(r["schema"]))).parquet(r["path"])
            if not verify or fingerprint(df) == (r["rows"], r["checksum"]):
                return df
            log.warning("the cached copy %s of %s has another content", r["path"], name)
        return None

    def publish(self, spark: SparkSession, name: str, df: DataFrame, version: str = "") -> None:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        rows, checksum = fingerprint(spark.read.schema(df.schema).parquet(path))
        row = (name, version, path, df.schema.json(), rows, checksum, self._files(spark, path))
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def read(self, spark: SparkSession, name: str, load: Callable[[SparkSession], DataFrame], version: str = "", verify: bool = False) -> DataFrame:
        """The cached copy; where there is none, ``load`` is read, published, and read from there."""
        found = self.cached(spark, name, version, verify)
        if found is None:
            self.publish(spark, name, load(spark), version)
            found = self.cached(spark, name, version)
            if found is None:  # damaged at once: do without
                return load(spark)
        return found
