"""Skew-safe lookups: broadcast when bounded, else split hot keys from cold ones.

A key that holds a large share of the rows (a stop word, a frequent bigram,
a very active user) sends that share to one reducer in a shuffle join.  Keys
holding at least ``1 / HOT_SHARE`` of the rows are at most ``HOT_SHARE``
many, so their lookup rows form a table with a proven size bound: those rows
are joined map-side against a broadcast of it, and only the remaining (cold)
rows are shuffled against the full table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1/HOT_SHARE of all rows.
HOT_SHARE = 1000
# Lookup tables up to this many rows are broadcast whole.
BROADCAST_ROWS = 1_000_000

_MARK = "_qhot"


def hot_cold_join(big: DataFrame, table: DataFrame, on: list[str], hot: DataFrame, how: str = "left") -> DataFrame:
    """``big JOIN table USING (on)`` where ``hot`` (a bounded subset of ``table``) is broadcast.

    ``how`` is ``"left"`` or ``"inner"``.  Rows whose key is in ``hot`` never
    enter the shuffle.
    """
    tagged = big.join(F.broadcast(hot.withColumn(_MARK, F.lit(True))), on, "left")
    hot_rows = tagged.where(F.col(_MARK).isNotNull()).drop(_MARK)
    cold_rows = tagged.where(F.col(_MARK).isNull()).select(*big.columns).join(table, on, how)
    return hot_rows.unionByName(cold_rows)


def lookup(big: DataFrame, table: DataFrame, on: list[str], table_rows: int, how: str = "left",
           hot: DataFrame | None = None) -> DataFrame:
    """Join a lookup table: broadcast if ``table_rows`` is small, else hot/cold split
    (or a plain shuffle join, left to AQE's skew handling, when no hot set is known)."""
    if table_rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(table), on, how)
    if hot is None:
        return big.join(table, on, how)
    return hot_cold_join(big, table, on, hot, how)


def frequent_keys(df: DataFrame, on: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys of ``df`` holding at least ``1/share`` of its rows (at most ``share`` keys).

    One partially aggregated ``groupBy`` plus a scalar total.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_qn"))
    total = counts.agg(F.sum("_qn")).collect()[0][0] or 0
    return counts.where(F.col("_qn") * F.lit(share) >= F.lit(total)).select(*on)
