"""Functions on Arrow batches, with state that a worker sets up once.

``map_batches(df, fn, schema)`` calls ``fn(batch, state)`` on batches cut by rows and bytes and
checks what it returns against the declared schema.  ``setup`` makes the state: once per
worker process and stage, not per task or batch.  A worker keeps the states of one stage
only; its first task of another stage drops them, so what models and tables take up doesn't
add up over a job.

Defined cases: empty batches are not passed on; a batch of one row may be larger than
``max_bytes``; ``fn`` may return None for no rows; a result whose columns or types differ from the
schema raises ``ValueError`` with both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_ROWS, MAX_BYTES = 8192, 8 << 20
_STATES: dict[str, Any] = {}
_STAGE: list = [None]


def _state(token: str, setup: Callable[[], Any] | None) -> Any:
    from pyspark import TaskContext

    stage = TaskContext.get().stageId()
    if _STAGE[0] != stage:
        _STAGE[0] = stage
        _STATES.clear()
    if setup is not None and token not in _STATES:
        _STATES[token] = setup()
    return _STATES.get(token)


def cut(batch: pa.RecordBatch, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in order, in pieces within both bounds (one row may be larger)."""
    for at in range(0, batch.num_rows, max_rows):
        part = batch.slice(at, max_rows)
        if part.num_rows > 1 and part.nbytes > max_bytes:
            half = part.num_rows // 2
            yield from cut(part.slice(0, half), max_rows, max_bytes)
            yield from cut(part.slice(half), max_rows, max_bytes)
        else:
            yield part


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch, Any], pa.RecordBatch | None], schema: T.StructType | str,
                setup: Callable[[], Any] | None = None, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    token, names = uuid.uuid4().hex, schema.fieldNames()
    types = [f.type for f in to_arrow_schema(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _state(token, setup)
        for batch in batches:
            for part in cut(batch, max_rows, max_bytes):
                out = fn(part, state)
                if out is None or not out.num_rows:
                    continue
                if out.schema.names != names or any(a != b and not _alike(a, b) for a, b in zip(out.schema.types, types)):
                    raise ValueError(f"declared {dict(zip(names, map(str, types)))}, got {dict(zip(out.schema.names, map(str, out.schema.types)))}")
                yield out

    return df.mapInArrow(run, schema)


def _alike(a: pa.DataType, b: pa.DataType) -> bool:
    """The same type but for names and nullability inside lists, and time zones."""
    if pa.types.is_list(a) and pa.types.is_list(b):
        return a.value_type == b.value_type or _alike(a.value_type, b.value_type)
    return a.id == b.id and not (pa.types.is_decimal(a) or pa.types.is_struct(a))
