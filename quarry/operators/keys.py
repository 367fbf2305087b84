"""Partition-independent row keys: seeded hash, exact k-th boundary, ranks.

Spark's ``sample``/``randomSplit`` depend on how the rows are partitioned, so
every seeded operator here orders rows by a 60-bit hash of a unique key
instead.  The same hash can be written in SQL on any engine that has ``md5``::

    h = conv(substring(md5(concat_ws('|', <key text>, '<seed>')), 1, 15), 16, 10)

Ties on ``h`` (only possible for duplicate keys) are broken by the key text.

Exact cut-offs ("the first k rows in hash order") never sort the data: a
materialised count per high-bit hash bucket locates the bucket that holds
row k, and that bucket's ``(h, key)`` pairs (a few ten thousand rows even at
10^12 rows) are brought to the driver.  The result is a
literal boundary, so the split itself is a plain filter that Catalyst can
push into the scan and that gives the same rows on every re-execution.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

H = "_qh"  # 60-bit seeded hash (bigint)
K = "_qk"  # key text, tie-break for equal hashes
T = "_qt"  # number of a row among those that share a cut-off's key
HASH_BITS = 60


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


# Text of a NULL key part: ('a', NULL) and (NULL, 'a') are different keys.
NULL_PART = "\\N"


def key_text(*cols) -> Column:
    """``'|'``-joined text of the key columns, NULL parts marked."""
    return F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit(NULL_PART)) for c in cols])


def seeded_hash(key: Column, seed) -> Column:
    """60-bit non-negative hash of ``key`` and ``seed``."""
    text = F.concat_ws("|", key, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def with_hash_key(df: DataFrame, key_cols, seed) -> DataFrame:
    """Add the sampling key columns ``_qk`` (text) and ``_qh`` (hash)."""
    if isinstance(key_cols, (str, Column)):
        key_cols = [key_cols]
    return df.withColumn(K, key_text(*key_cols)).withColumn(H, seeded_hash(F.col(K), seed))


def drop_hash_key(df: DataFrame) -> DataFrame:
    return df.drop(H, K, T)


def hash_fraction_predicate(fraction: float) -> Column:
    """Per-row Bernoulli test ``h < fraction * 2^60`` (narrow, pushable)."""
    if fraction >= 1.0:
        return F.lit(True)
    if fraction <= 0.0:
        return F.lit(False)
    return F.col(H) < F.lit(int(fraction * (1 << HASH_BITS)))


def estimated_rows(df: DataFrame) -> int:
    """Row estimate from Catalyst statistics (size / row width); nothing is executed."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        rc = stats.rowCount()  # py4j gives None or a Scala Option
        if isinstance(rc, int):
            return rc
        if rc is not None and rc.isDefined():
            return int(str(rc.get()))
        size = stats.sizeInBytes()  # py4j turns the BigInt into a Python int
        size = size if isinstance(size, int) else int(str(size))
        width = max(int(df._jdf.schema().defaultSize()), 1)
        return size // width
    except Exception:  # noqa: BLE001 - estimates are advisory
        return 1 << 40


@dataclass(frozen=True)
class Boundary:
    """The ``(h, key)`` of one row; rows at or before it pass ``at_or_before``.

    ``taken`` is set where several rows share the key and only so many of them lie at or
    before the cut; ``number_ties`` numbers those rows.
    """

    h: int
    key: str
    taken: int | None = None

    def _here(self) -> Column:
        return F.struct(F.lit(self.h).cast("bigint").alias(H), F.lit(self.key).alias(K))

    def shared(self) -> Column:
        return position() == self._here()

    def at_or_before(self) -> Column:
        """``(h, key) <= (self.h, self.key)`` as one struct comparison (lexicographic),
        so the hash is evaluated once per row rather than once per disjunct."""
        if self.taken is not None:
            return (position() < self._here()) | (self.shared() & (F.col(T) < self.taken))
        return position() <= self._here()


def position() -> Column:
    """The row's place in seeded hash order, as a comparable struct."""
    return F.struct(F.col(H).alias(H), F.col(K).alias(K))


class HashOrder:
    """Rows of a keyed frame in ``(h, key)`` order, without sorting them.

    One pass counts rows per fine bucket (the top ``fine_bits`` hash bits,
    sized from the optimizer's row estimate); up to ``2^14`` buckets the counts
    are simply collected, above that the count table (at most ``2^fine_bits``
    rows) is checkpointed.  The driver
    reads a ``2^coarse_bits``-row coarse view of it and, for each wanted row,
    the fine counts inside one coarse bucket, which locates the fine bucket
    holding that row.  A second pass brings the ``(h, key)`` pairs of those
    fine buckets (about ``n / 2^fine_bits`` rows each) to the driver.  So any
    cut-off of up to ~10^12 rows costs two passes over the key columns; a
    fine bucket above ``leaf_rows`` rows is narrowed further by recursive
    histograms restricted to its hash range.
    """

    def __init__(self, keyed: DataFrame, fine_bits: int | None = None, coarse_bits: int = 12, leaf_rows: int = 100_000,
                 fanout_bits: int = 12):
        self.slim = keyed.select(H, K)
        if fine_bits is None:
            # ~leaf/4 rows per fine bucket by the optimizer's size estimate (no job runs);
            # a wrong estimate only changes speed: a bigger count table or one narrowing pass.
            fine_bits = 10
            while fine_bits < 24 and estimated_rows(self.slim) > (leaf_rows // 4) << fine_bits:
                fine_bits += 1
        self.fine_bits = fine_bits
        self.coarse_bits = min(coarse_bits, fine_bits)
        self.leaf_rows = leaf_rows
        self.fanout_bits = fanout_bits
        self._fine = None  # checkpointed count table (large fine tables)
        self._fine_list = None  # collected counts (small fine tables)
        self._coarse = None

    # -- pass 1: fine counts, materialised once
    def _fine_counts(self) -> DataFrame:
        if self._fine is None:
            ensure_checkpoint_dir(self.slim.sparkSession)
            b = F.shiftright(F.col(H), HASH_BITS - self.fine_bits).alias("b")
            self._fine = self.slim.groupBy(b).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
        return self._fine

    # Fine tables up to this many buckets are simply collected (one job, no checkpoint).
    DIRECT_BITS = 14

    def _direct(self) -> list[tuple[int, int]]:
        if self._fine_list is None:
            b = F.shiftright(F.col(H), HASH_BITS - self.fine_bits).alias("b")
            rows = self.slim.groupBy(b).agg(F.count(F.lit(1)).alias("n")).collect()
            self._fine_list = sorted((int(r["b"]), int(r["n"])) for r in rows)
        return self._fine_list

    def _coarse_counts(self) -> list[tuple[int, int]]:
        if self.fine_bits <= self.DIRECT_BITS:
            return self._direct()
        if self._coarse is None:
            shift = self.fine_bits - self.coarse_bits
            rows = self._fine_counts().groupBy(F.shiftright("b", shift).alias("cb")).agg(F.sum("n").alias("n")).collect()
            self._coarse = sorted((int(r["cb"]), int(r["n"])) for r in rows)
        return self._coarse

    def count(self) -> int:
        return sum(c for _, c in self._coarse_counts())

    def _locate(self, k: int) -> tuple[int, int, int] | None:
        """(fine bucket, rows before it, rows in it) for the k-th row (1-based)."""
        if self.fine_bits <= self.DIRECT_BITS:
            before = 0
            for b, c in self._direct():
                if before + c >= k:
                    return b, before, c
                before += c
            return None
        before = 0
        for cb, c in self._coarse_counts():
            if before + c >= k:
                break
            before += c
        else:
            return None
        shift = self.fine_bits - self.coarse_bits
        fine = self._fine_counts().where(F.shiftright("b", shift) == F.lit(cb)).collect()
        for r in sorted(fine, key=lambda r: r["b"]):
            if before + r["n"] >= k:
                return int(r["b"]), before, int(r["n"])
            before += int(r["n"])
        raise AssertionError("fine counts disagree with coarse counts")

    def _histogram(self, lo: int, width: int) -> list[tuple[int, int]]:
        shift = max(width - self.fanout_bits, 0)
        h = F.col(H)
        rng = self.slim.where((h >= F.lit(lo)) & (h < F.lit(lo + (1 << width))))
        rows = rng.groupBy(F.shiftright(h - F.lit(lo), shift).alias("b")).count().collect()
        return sorted((int(r["b"]), int(r["count"])) for r in rows)

    def _narrow(self, lo: int, width: int, before: int, k: int) -> tuple[int, int, int]:
        """Recurse inside an oversized bucket until the row's bucket is small."""
        while True:
            shift = max(width - self.fanout_bits, 0)
            cum = 0
            for b, c in self._histogram(lo, width):
                if before + cum + c >= k:
                    break
                cum += c
            before += cum
            lo, width = lo + (b << shift), shift
            if c <= self.leaf_rows or width == 0:  # one hash value: a key that very many rows share
                return lo, width, before

    def boundaries(self, ks: list[int]) -> dict[int, Boundary | None]:
        """Boundary of each k-th row (1-based); ``None`` if ``k`` covers all rows;
        ``k <= 0`` gives a boundary below every row.  One collecting pass for all ks."""
        out: dict[int, Boundary | None] = {}
        ranges = {}  # k -> (lo, width, before)
        width_fine = HASH_BITS - self.fine_bits
        for k in ks:
            if k <= 0:
                out[k] = Boundary(-1, "")
                continue
            loc = self._locate(k)
            if loc is None:
                out[k] = None
                continue
            fb, before, c = loc
            lo = fb << width_fine
            if c > self.leaf_rows:
                ranges[k] = self._narrow(lo, width_fine, before, k)
            else:
                ranges[k] = (lo, width_fine, before)
        if ranges:
            h = F.col(H)
            spans = sorted({(lo, width) for lo, width, _ in ranges.values()})
            cond = None
            for lo, width in spans:
                c = (h >= F.lit(lo)) & (h < F.lit(lo + (1 << width)))
                cond = c if cond is None else cond | c
            rows = self.slim.where(cond).groupBy(H, K).count().collect()
            rows.sort(key=lambda r: (r[0], r[1]))  # str order = UTF-8 byte order = Spark order
            for k, (lo, width, before) in ranges.items():
                for h_, key_, n in (r for r in rows if lo <= r[0] < lo + (1 << width)):
                    if before + n >= k:
                        out[k] = Boundary(int(h_), key_, None if before + n == k else k - before)
                        break
                    before += n
        return out

    def boundary(self, k: int) -> Boundary | None:
        return self.boundaries([k])[k]


def number_ties(keyed: DataFrame, bounds: list[Boundary | None]) -> DataFrame:
    """``keyed`` with a number (from 0) for the rows that share the key of a cut-off which
    lies among them, in the order of a hash of the whole row; equal rows are interchangeable.
    Unchanged where every cut-off lies between keys, as with a unique key."""
    inexact = list(dict.fromkeys((b.h, b.key) for b in bounds if b is not None and b.taken is not None))
    if not inexact:
        return keyed
    marks = [Boundary(h, key) for h, key in inexact]
    others = keyed
    for mark in marks:
        others = others.where(~mark.shared())
    out = others.withColumn(T, F.lit(0).cast("bigint"))
    content = F.xxhash64(*[F.col(c) for c in keyed.columns])
    for mark in marks:
        out = out.unionByName(rank_by(keyed.where(mark.shared()), [content], T))
    return out


def first_k(keyed: DataFrame, order: HashOrder, k: int) -> tuple[DataFrame, DataFrame]:
    """Exactly the first ``k`` rows in hash order, and the others."""
    b = order.boundary(k)
    if b is None:
        return keyed, keyed.where(F.lit(False))
    numbered = number_ties(keyed, [b])
    return numbered.where(b.at_or_before()).drop(T), numbered.where(~b.at_or_before()).drop(T)


def hash_rank(keyed: DataFrame, name: str, rows_per_bucket: int = 1_000_000, max_bits: int = 20) -> DataFrame:
    """0-based gapless row number in ``(h, key)`` order, fully distributed.

    The hash is uniform, so its high bits give evenly filled buckets.  The
    bucket count is picked from the row count so that a bucket holds about
    ``rows_per_bucket`` rows (up to ``2^max_bits`` buckets, i.e. ~10^12 rows);
    per-bucket counts become offsets by a running sum over at most
    ``2^max_bits`` rows, which are broadcast back (a proven size bound), and
    ``row_number`` runs inside each bucket.  Nothing is collected but the
    row count.
    """
    n = keyed.count()
    bits = 0
    while bits < max_bits and n > rows_per_bucket * (1 << bits):
        bits += 1
    bucket = F.shiftright(F.col(H), HASH_BITS - bits)
    with_b = keyed.withColumn("_qb", bucket)
    counts = with_b.groupBy("_qb").agg(F.count(F.lit(1)).alias("_qn"))
    before = Window.orderBy("_qb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_qb", F.coalesce(F.sum("_qn").over(before), F.lit(0)).cast("bigint").alias("_qoff"))
    joined = with_b.join(F.broadcast(offsets), "_qb", "inner")
    w = Window.partitionBy("_qb").orderBy(F.col(H), F.col(K))
    return joined.withColumn(name, (F.row_number().over(w) - 1).cast("bigint") + F.col("_qoff")).drop("_qb", "_qoff")


def rank_by(df: DataFrame, order_cols, name: str, num_partitions: int | None = None) -> DataFrame:
    """0-based gapless row number in the order of ``order_cols`` (must be unique).

    Range-partition, sort within partitions, number rows inside each
    partition, and add per-partition offsets.  The numbered layout is cut
    from its lineage with a reliable ``checkpoint()`` so that a lost executor
    cannot re-run the range sampling into a different layout after the
    offsets were computed.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if isinstance(order_cols, (str, Column)):
        order_cols = [order_cols]
    order_cols = [_col(c) for c in order_cols]
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n_parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_qpid", F.spark_partition_id())
        .withColumn("_qmid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = {int(r["_qpid"]): int(r["count"]) for r in ranged.groupBy("_qpid").count().collect()}
    n_seen = max(counts) + 1 if counts else 1
    offsets, acc = [], 0
    for p in range(n_seen):
        offsets.append(acc)
        acc += counts.get(p, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), (F.col("_qpid") + 1).cast("int"))
    local = F.col("_qmid") - F.shiftleft(F.col("_qpid").cast("bigint"), 33)
    return ranged.withColumn(name, local + offset).drop("_qpid", "_qmid")
