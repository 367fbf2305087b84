"""Array and math column functions used by scoring and evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.fixed import GENERATION_CAP_TOKENS


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def argmax(logits) -> Column:
    """0-based index of the largest element; the first maximum wins."""
    x = _c(logits)
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def prompt_half(ids) -> Column:
    """First ``size // 2`` elements (integer division)."""
    x = _c(ids)
    return F.slice(x, 1, F.floor(F.size(x) / 2).cast("int"))


def generation_score(generated_len, cap_len: int = GENERATION_CAP_TOKENS) -> Column:
    """``min(generated_len / cap_len, 1.0)``."""
    return F.least(_c(generated_len).cast("double") / F.lit(float(cap_len)), F.lit(1.0))
