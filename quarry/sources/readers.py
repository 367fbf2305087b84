"""Typed readers, named-split loading, source fallback and dataset handles."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixed import SHUFFLE_SEED

log = logging.getLogger(__name__)

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.LongType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table as a distributed frame (lazy; nothing is read yet)."""
    return spark.read.format(fmt).load(path)


def read_ratings_tsv(spark: SparkSession, path: str, schema: T.StructType = RATINGS_SCHEMA) -> DataFrame:
    """Headerless tab-separated file with explicit names and int64 types.

    ``FAILFAST`` makes a malformed line an error instead of a NULL row.
    """
    return spark.read.schema(schema).option("sep", "\t").option("header", "false").option("mode", "FAILFAST").csv(path)


def load_splits(spark: SparkSession, root: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                splits=("train", "validation", "test")) -> dict[str, DataFrame]:
    """Named splits stored as ``root/split=<name>/``.

    One reader over the root exposes ``split`` as a partition column, so each
    split's filter prunes the other directories at planning time.
    """
    base = spark.read.parquet(root)
    out = {}
    for s in splits:
        part = base.where(F.col("split") == s).drop("split")
        out[s] = transform(part) if transform else part
    return out


def is_missing_path(err: Exception) -> bool:
    return isinstance(err, AnalysisException) and (
        getattr(err, "getCondition", lambda: None)() == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err)
    )


def read_first_available(spark: SparkSession, paths: list[str], reader: Callable[[SparkSession, str], DataFrame],
                         fallback: Callable[[SparkSession], DataFrame] | None = None) -> DataFrame:
    """First path that exists, else ``fallback`` (with a warning).

    Only a missing path moves on to the next candidate: Spark reads lazily,
    so corrupt data fails at the action and must not be masked here.
    """
    for p in paths:
        try:
            return reader(spark, p)
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            log.warning("source %s not found, trying the next one", p)
    if fallback is None:
        raise FileNotFoundError(f"none of the sources exist: {paths}")
    log.warning("no source found, using the fallback")
    return fallback(spark)


def dummy_instructions(spark: SparkSession, n: int) -> DataFrame:
    """Offline stand-in rows ``instruction, input, output``; at most 1,000."""
    from quarry.fixed import DUMMY_INPUT, DUMMY_INSTRUCTION, DUMMY_MAX_ROWS, DUMMY_OUTPUT

    return spark.range(min(n, DUMMY_MAX_ROWS)).select(
        F.format_string(DUMMY_INSTRUCTION, "id").alias("instruction"),
        F.lit(DUMMY_INPUT).alias("input"),
        F.format_string(DUMMY_OUTPUT, "id", "id").alias("output"),
    )


def instruction_pairs(conversations: DataFrame, with_context: bool = False) -> DataFrame:
    """Instruction rows from conversation turns: a user turn ``t`` and the
    assistant turn ``t + 1`` of the same conversation.

    With ``with_context`` the system turn ``t - 1`` (if any) becomes ``input``.
    Pairs are equi-joins on the unique ``(conv_id, turn)`` key rather than a
    window over each conversation, so one very long conversation is spread
    over many tasks instead of being sorted in one.
    """
    c = conversations.select("conv_id", "turn", "role", "text")
    user = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    nxt = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    pairs = user.join(nxt, ["conv_id", "turn"], "inner")
    if with_context:
        sys_prev = c.where(F.col("role") == "system").select(
            "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("input")
        )
        pairs = pairs.join(sys_prev, ["conv_id", "turn"], "left").withColumn("input", F.coalesce("input", F.lit("")))
    else:
        pairs = pairs.withColumn("input", F.lit(""))
    return pairs.select("conv_id", "turn", "instruction", "input", "output")


def load_instructions(spark: SparkSession, name: str, sample_size: int, sources: dict[str, Callable[[SparkSession], DataFrame]],
                      key=None, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Source dispatch by name, then a seeded ``sample_size`` sample.

    An unknown name raises ``ValueError``.
    """
    from quarry.operators.sampling import sample_n

    if name not in sources:
        raise ValueError(f"no source is registered under {name!r}")
    df = sources[name](spark)
    return sample_n(df, sample_size, key, seed) if key is not None else df


@dataclass(frozen=True)
class DatasetHandle:
    """A dataset stored as parquet, with its schema, handed between steps."""

    path: str
    schema: T.StructType

    @staticmethod
    def save(df: DataFrame, path: str) -> "DatasetHandle":
        df.write.mode("overwrite").parquet(path)
        return DatasetHandle(path, df.schema)

    def load(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def find_artifact(spark: SparkSession, root: str, name: str = "model.ubj") -> DataFrame:
    """``(path, length)`` of the first file named ``name`` under ``root`` (by path).

    Falls back to any file; no file at all raises ``FileNotFoundError``.
    File contents are never read (the ``content`` column is pruned).
    """

    def listing(glob: str | None) -> DataFrame:
        r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob:
            r = r.option("pathGlobFilter", glob)
        return r.load(root).select("path", "length").orderBy("path").limit(1)

    for glob in (name, None):
        try:
            found = listing(glob)
        except AnalysisException as e:
            if is_missing_path(e):
                raise FileNotFoundError(root) from e
            raise
        if found.take(1):
            return found
    raise FileNotFoundError(f"no artifact under {root}")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    import uuid

    from quarry.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-io/{name}-{uuid.uuid4().hex[:12]}"
