"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back: cut from
    its lineage, and the same rows however often it is read or an executor is lost."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/saved-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(k)


_KEPT: list = []  # what this worker keeps from task to task, of one stage
_OF_STAGE: list = [None]


def kept_in_stage(build):
    """``build``, whose last result a worker keeps until it gets a task of another stage."""
    kept = functools.lru_cache(maxsize=1)(build)
    _KEPT.append(kept)
    return kept


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its tasks, and what they held would
    add up from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def begin_task() -> None:
    from pyspark import TaskContext

    stage = TaskContext.get().stageId()
    if _OF_STAGE[0] != stage:
        _OF_STAGE[0] = stage
        for kept in _KEPT:
            kept.cache_clear()
        give_back()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def arrow_rows(batches: Iterator[pa.RecordBatch], text_at: int, max_bytes: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches re-cut so that their texts (column ``text_at``) hold about ``max_bytes``
    at most (one longer text stands alone), each with that column as Python strings."""
    for batch in batches:
        column = batch.column(text_at)
        sizes = [0 if n is None else n for n in pc.binary_length(column).to_pylist()]
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > max_bytes:
                yield batch.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start), column.slice(start).to_pylist()


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch, list], pa.RecordBatch]], schema: str, text_at: int = 1, max_bytes: int = 8 << 20) -> DataFrame:
    """``mapInArrow`` over text batches of bounded size (``max_bytes``).  ``make`` runs once per task and
    returns the function that turns a batch and its texts into an output batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        step = make()
        for batch, texts in arrow_rows(batches, text_at, max_bytes):
            out = step(batch, texts)
            if out is not None and out.num_rows:
                yield out
        del step
        give_back()

    return df.mapInArrow(run, schema)
