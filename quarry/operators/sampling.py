"""Seeded sampling, exact splits, head and renumbering (all partition-independent).

Every operator orders rows by the seeded hash of a unique key (see
``keys``), so the same seed gives the same rows under any partitioning and
on any engine that can compute ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.fixed import (
    RATING_VAL_FRACTION,
    SENTENCE_SEED,
    SEQUENTIAL_TRAIN,
    SEQUENTIAL_VAL,
    SHUFFLE_SEED,
    TABULAR_SEED,
    TEST_SIZE,
)

from quarry.operators.keys import (
    H,
    K,
    T,
    HashOrder,
    drop_hash_key,
    first_k,
    hash_fraction_predicate,
    hash_rank,
    number_ties,
    rank_by,
    with_hash_key,
)


def sample_n_counted(df: DataFrame, n: int, key, seed: int = SHUFFLE_SEED) -> tuple[DataFrame, bool, int]:
    """``sample_n_keyed`` plus the exact number of rows it keeps (no extra pass)."""
    keyed = with_hash_key(df, key, seed)
    order = HashOrder(keyed)
    total = order.count()
    if n >= total:
        return keyed, False, total
    return first_k(keyed, order, n)[0], True, n


def sample_n_keyed(df: DataFrame, n: int, key, seed: int = SHUFFLE_SEED) -> tuple[DataFrame, bool]:
    """First ``n`` rows in seeded hash order when ``n`` is below the row count.

    Returns the keyed frame (hash columns kept, so later steps can keep the
    shuffled order) and whether a sample was taken.  Otherwise all rows are
    returned unchanged, in their source order.
    """
    keyed = with_hash_key(df, key, seed)
    order = HashOrder(keyed)
    if n >= order.count():
        return keyed, False
    return first_k(keyed, order, n)[0], True


def sample_n(df: DataFrame, n: int, key, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Shuffle with ``seed`` and keep the first ``n`` rows, only if ``n < rows``."""
    return drop_hash_key(sample_n_keyed(df, n, key, seed)[0])


def sample_capped(df: DataFrame, n: int, key, seed: int = TABULAR_SEED) -> DataFrame:
    """``min(n, rows)`` rows in seeded order; ``n == 0`` keeps everything."""
    if n <= 0:
        return df
    return sample_n(df, n, key, seed)


def sample_fraction(df: DataFrame, fraction: float, key, seed: int = SENTENCE_SEED) -> DataFrame:
    """Independent per-row sample: a narrow hash filter, pushed before later work."""
    return drop_hash_key(with_hash_key(df, key, seed).where(hash_fraction_predicate(fraction)))


def _cut(df: DataFrame, key, seed, cut_fn) -> tuple[DataFrame, DataFrame]:
    keyed = with_hash_key(df, key, seed)
    order = HashOrder(keyed)
    k = cut_fn(order.count())
    first, rest = first_k(keyed, order, k)
    return drop_hash_key(first), drop_hash_key(rest)


def label_by_cutoffs(keyed: DataFrame, order: HashOrder, cuts: list[tuple[str, int]], last: str, name: str = "split") -> DataFrame:
    """One pass: ``name`` = first label whose cut-off (row count) covers the row.

    ``cuts`` are ``(label, first_k)`` in increasing ``first_k``; rows beyond the
    last cut get ``last``.  Every label is decided by literal boundaries, so
    a re-executed task labels its rows the same way.
    """
    expr = None
    bounds = order.boundaries([k for _, k in cuts])
    for label, k in cuts:
        b = bounds[k]
        cond = F.lit(True) if b is None else b.at_or_before()
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    numbered = number_ties(keyed, list(bounds.values()))
    return numbered.withColumn(name, expr.otherwise(F.lit(last)) if expr is not None else F.lit(last)).drop(T)


def train_test_labelled(df: DataFrame, test_size: float = TEST_SIZE, key=None, seed: int = TABULAR_SEED,
                        names: tuple[str, str] = ("train", "validation")) -> DataFrame:
    """``train_test_split`` as one frame with a ``split`` column (one scan for both sides)."""
    keyed = with_hash_key(df, key, seed)
    order = HashOrder(keyed)
    k = int(order.count() * (1.0 - test_size))
    return drop_hash_key(label_by_cutoffs(keyed, order, [(names[0], k)], names[1]))


def train_test_split(df: DataFrame, test_size: float = TEST_SIZE, key=None, seed: int = TABULAR_SEED) -> tuple[DataFrame, DataFrame]:
    """Shuffled split; train gets ``int(n * (1 - test_size))`` rows."""
    return _cut(df, key, seed, lambda n: int(n * (1.0 - test_size)))


def permutation_split(df: DataFrame, val_fraction: float = RATING_VAL_FRACTION, key=None, seed: int = SHUFFLE_SEED) -> tuple[DataFrame, DataFrame]:
    """Permutation split with cut-off ``int(n * (1 - val_fraction))``."""
    return _cut(df, key, seed, lambda n: int(n * (1.0 - val_fraction)))


def sequential_cutoffs(n: int, train: float = SEQUENTIAL_TRAIN, val: float = SEQUENTIAL_VAL) -> tuple[int, int]:
    """Positions ``int(train*n)`` and ``int(train*n) + int(val*n)``; the rest is test."""
    a = int(train * n)
    return a, a + int(val * n)


def sequential_split_hashed(keyed: DataFrame, train: float = SEQUENTIAL_TRAIN, val: float = SEQUENTIAL_VAL) -> dict[str, DataFrame]:
    """80/10/10 by position in seeded hash order (after ``sample_n_keyed``)."""
    order = HashOrder(keyed)
    a, b = sequential_cutoffs(order.count(), train, val)
    bounds = order.boundaries([a, b])
    first_a, first_b = (F.lit(True) if bounds[x] is None else bounds[x].at_or_before() for x in (a, b))
    keyed = number_ties(keyed, list(bounds.values()))
    return {
        "train": drop_hash_key(keyed.where(first_a)),
        "validation": drop_hash_key(keyed.where(~first_a & first_b)),
        "test": drop_hash_key(keyed.where(~first_b)),
    }


class OrderPositions:
    """Rank of each distinct (unique, ascending) order key, computed once.

    Only the order columns are ranked and checkpointed; ``keys_at`` brings at
    most ``len(positions)`` rows to the driver.
    """

    def __init__(self, df: DataFrame, order_cols: list[str]):
        self.order_cols = order_cols
        self.ranked = rank_by(df.select(*order_cols), [F.col(c) for c in order_cols], "_qpos")
        self.n = self.ranked.count()

    def keys_at(self, positions: list[int]) -> dict[int, tuple]:
        wanted = [p for p in positions if 0 <= p < self.n]
        rows = self.ranked.where(F.col("_qpos").isin(wanted)).collect() if wanted else []
        return {int(r["_qpos"]): tuple(r[c] for c in self.order_cols) for r in rows}


def _at_or_before(df: DataFrame, order_cols: list[str], key: tuple | None) -> Column:
    if key is None:
        return F.lit(False)
    types = {f.name: f.dataType for f in df.schema.fields}
    bound = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order_cols, key)])
    return F.struct(*[F.col(c).alias(c) for c in order_cols]) <= bound


def sequential_split(df: DataFrame, order_cols, train: float = SEQUENTIAL_TRAIN, val: float = SEQUENTIAL_VAL) -> dict[str, DataFrame]:
    """80/10/10 by position in the ascending order of ``order_cols`` (unique, no shuffle of the rows).

    The boundary keys are found by ranking the order columns alone; the split
    itself is two literal tuple comparisons on the original rows.
    """
    first_a, first_b = _sequential_bounds(df, order_cols, train, val)
    return {
        "train": df.where(first_a),
        "validation": df.where(~first_a & first_b),
        "test": df.where(~first_b),
    }


def _sequential_bounds(df: DataFrame, order_cols, train: float, val: float) -> tuple[Column, Column]:
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    pos = OrderPositions(df, order_cols)
    a, b = sequential_cutoffs(pos.n, train, val)
    keys = pos.keys_at([a - 1, b - 1])
    return _at_or_before(df, order_cols, keys.get(a - 1)), _at_or_before(df, order_cols, keys.get(b - 1))


def sequential_labelled(df: DataFrame, order_cols, train: float = SEQUENTIAL_TRAIN, val: float = SEQUENTIAL_VAL) -> DataFrame:
    """``sequential_split`` as one frame with a ``split`` column, read once for all splits."""
    first_a, first_b = _sequential_bounds(df, order_cols, train, val)
    return df.withColumn("split", F.when(first_a, "train").when(first_b, "validation").otherwise("test"))


def split_column(parts: dict[str, DataFrame]) -> DataFrame:
    """One frame with a ``split`` column instead of a dict of frames."""
    out = None
    for name, part in parts.items():
        tagged = part.withColumn("split", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


# Above this many rows, head() ranks instead of gathering the top rows in one task.
TOP_K_ROWS = 100_000


def head(df: DataFrame, n: int, order_cols) -> DataFrame:
    """First ``n`` rows by an explicit (unique) order.

    Small ``n`` is a distributed top-k (each task keeps its best ``n``, one
    task merges them); a large ``n`` would make that merge task hold ``n``
    rows, so it becomes a distributed rank and a filter instead.
    """
    if isinstance(order_cols, (str, Column)):
        order_cols = [order_cols]
    if n <= TOP_K_ROWS:
        return df.orderBy(*order_cols).limit(n)
    return rank_by(df, order_cols, "_qpos").where(F.col("_qpos") < n).drop("_qpos")


def renumber(df: DataFrame, order_cols, name: str = "row_idx") -> DataFrame:
    """Row numbers from 0 in the given (unique) order."""
    return rank_by(df, order_cols, name)


def renumber_hashed(keyed: DataFrame, name: str = "row_idx") -> DataFrame:
    """Row numbers from 0 in seeded hash order (no range sampling, no checkpoint)."""
    return drop_hash_key(hash_rank(keyed, name))


__all__ = [
    "H",
    "K",
    "head",
    "permutation_split",
    "renumber",
    "renumber_hashed",
    "sample_capped",
    "sample_fraction",
    "sample_n",
    "sample_n_counted",
    "sample_n_keyed",
    "sequential_cutoffs",
    "sequential_labelled",
    "sequential_split",
    "sequential_split_hashed",
    "OrderPositions",
    "label_by_cutoffs",
    "split_column",
    "train_test_labelled",
    "train_test_split",
]
