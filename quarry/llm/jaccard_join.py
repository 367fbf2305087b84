"""N-gram Jaccard self-join by T-occurrence search (DivideSkip), and its components.

Texts become sets of 64-bit shingle hashes inside the tasks that read them.  A set of
``s`` shingles can only link with one that shares at least ``T = ceil(t * s)`` of them.

1. *Classes.*  Equal sets share a fingerprint; from here on one row stands for a class.
2. *Short lists, distributed.*  Shingles have one global order: those frequent in a bounded
   sample of documents, or found to have long lists, last, else by hash.  A linked pair shares at least ``l`` of the
   first ``s - T + l`` shingles of both, with ``l`` half of ``s - T``.  Only those
   shingles are shuffled.  Short inverted lists yield pairs, counted and held against
   ``l``; a long list, or a frequent shingle, yields a star instead, one row per entry.
   The order only decides how many candidates there are, never which links are found.
3. *Groups.*  Components of the candidates bring the whole sets together that may link.
   A group of more than ``GROUP_SHINGLES`` is dealt into blocks, and every two blocks meet.
4. *DivideSkip.*  Within a group a set probes the inverted lists of the smaller ones: its
   short lists are heap-merged, ids that reach ``T - L`` are looked for in its ``L`` long
   lists by binary search.  A pair whose ends are already joined isn't verified again, so
   large groups of near copies cost links, not pairs.
5. Components of the links label every document with the smallest id.

Defined cases: a null text, or one without words, is an empty set, linked with nothing
(its own id is its component); fewer words than a shingle make one shingle of all;
repeated rows and copies share a component; an empty table gives no rows; other columns
are not read.  Hashes have 64 bits: two unequal sets of a corpus of 10^9 documents share a
fingerprint with probability below 3 %.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import arrow_rows, saved, shuffle_partitions
from quarry.llm.components import connected_components

#: Shingles whose lists would be longer than this count as frequent too (of those at most
#: so many), which takes them out of most documents' first shingles.
LONG_LIST, LONG_LISTS = 48, 4_000_000
#: A list that still is up to this long yields its pairs, a longer one a star.
SHORT_LIST = 256
#: Shingles a task holds of one group, at most twice.
GROUP_SHINGLES = 400_000
#: Documents of the sample that tells frequent shingles, and in how many of them they stand.
SAMPLE_DOCS, SAMPLE_HITS = 20_000, 3
#: Bytes of text hashed at once.
HASH_BYTES = 2 << 20
#: Slots of the filter that keeps other texts from the shuffle of the candidates' texts.
SLOTS = 1 << 23
#: Cost ratio of DivideSkip's choice of long lists.
MU = 0.0085

_rng = np.random.default_rng(20_240_229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``k``-word shingles (A-Z lower-cased,
    words between the six ASCII blanks)."""
    data = [b" " if t is None else t.encode().lower() for t in texts]
    buf = np.frombuffer(b" ".join([*data, b""]), dtype=np.uint8)
    blank = _SPACE[buf]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return [np.empty(0, np.uint64)] * len(texts)
    inside = np.arange(len(buf), dtype=np.int64)[~blank] - np.repeat(start, stop - start)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(inside.max()), _STEP)]))
        word = _mix(np.add.reduceat(_BYTE[buf[~blank]] * power[inside], np.cumsum(stop - start) - (stop - start)) + (stop - start).astype(np.uint64))
        ends = np.cumsum([len(d) + 1 for d in data])
        last = np.searchsorted(start, ends)
        first = np.concatenate([[0], last[:-1]])
        rolled = np.zeros(max(0, len(word) - k + 1), np.uint64)
        for i in range(k):
            rolled = rolled * _STEP + word[i : i + len(rolled)]
        rolled = _mix(rolled)
        out = []
        for a, b in zip(first.tolist(), last.tolist()):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                whole = _mix(np.array([b - a], np.uint64))  # the length: unlike a shingle's hash
                for w in word[a:b]:
                    whole = whole * _STEP + w
                out.append(_mix(whole))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(_mix(np.array([_mix(s + _STEP).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


@dataclass(frozen=True)
class Threshold:
    """A pair links when ``den * intersection >= num * union``."""

    num: int = 90
    den: int = 100

    def least(self, size: int) -> int:
        """Shingles that a set of this size shares with any set it links with."""
        return -(-self.num * size // self.den)

    def short(self, size: int) -> tuple[int, int]:
        """How many first shingles are shuffled, and how many of them a linked pair shares."""
        spare = size - self.least(size)
        lists = max(1, spare // 2)
        return min(size, spare + lists), lists

    def overlap(self, a: int, b: int) -> int:
        return -(-self.num * (a + b) // (self.num + self.den))

    def linked(self, common: int, a: int, b: int) -> bool:
        return self.den * common >= self.num * (a + b - common)


def _sets_of(batches: Iterator[pa.RecordBatch], k: int):
    for batch, texts in arrow_rows(batches, 1, HASH_BYTES):
        yield batch.column(0).to_pylist(), shingle_sets(texts, k)


def _ints(values, kind=np.int64) -> pa.Array:
    return pa.array(np.asarray(values, dtype=kind))


def classes(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, fp``; an empty set's ``fp`` is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets_of(batches, k):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _ints([len(s) for s in sets]), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())], names=["doc_id", "n_shingles", "fp"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, fp long")


def frequent_shingles(docs: DataFrame, k: int, n_docs: int) -> np.ndarray:
    """Sorted hashes that stand in ``SAMPLE_HITS`` or more of about ``SAMPLE_DOCS`` documents."""
    share = min(1 << 20, int(SAMPLE_DOCS / max(1, n_docs) * (1 << 20)))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 20)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets_of(batches, k):
            value, count = np.unique(np.concatenate(sets), return_counts=True)
            if len(value):
                yield pa.RecordBatch.from_arrays([_ints(value.view(np.int64)), _ints(count)], names=["shingle", "n"])

    counts = sample.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= SAMPLE_HITS).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def with_long_lists(first: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """``frequent`` and the shingles whose lists in ``first`` are long."""
    lengths = first.where("not frequent").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > LONG_LIST)
    found = lengths.orderBy(F.desc("n"), "shingle").limit(LONG_LISTS).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return np.union1d(frequent, found.view(np.uint64))


def first_shingles(docs: DataFrame, k: int, t: Threshold, frequent) -> DataFrame:
    """``shingle, fp, size, frequent``: what is shuffled of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for _, sets in _sets_of(batches, k):
            sizes = np.array([len(s) for s in sets])
            if not sizes.any():
                continue
            every = np.concatenate(sets)
            at = np.searchsorted(often, every)
            hot = often[np.minimum(at, len(often) - 1)] == every if len(often) else np.zeros(len(every), bool)
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.lexsort((hot, owner))  # the sets are sorted by hash already, and this sort is stable
            place = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            n_first = np.array([t.short(n)[0] if n else 0 for n in sizes.tolist()])
            order = order[place < n_first[owner]]
            fps = np.array([fingerprint(s) if len(s) else 0 for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([_ints(every[order].view(np.int64)), _ints(fps[owner[order]]), _ints(sizes[owner[order]], np.int32), pa.array(hot[order])], names=["shingle", "fp", "size", "frequent"])

    return docs.mapInArrow(run, "shingle long, fp long, size int, frequent boolean")


def _list_pairs(num: int, den: int):
    """Pairs of each short list; of a long one the star around its first entry (n = -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(shingle, fp, size) -> pa.RecordBatch | None:
            new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (fp[1:] != fp[:-1])])  # copies have the same rows
            shingle, fp, size = shingle[new], fp[new], size[new]
            begin = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
            length = np.diff(np.concatenate([begin, [len(shingle)]]))
            left, right, star = [], [], []
            for n in np.unique(length[(length > 1) & (length <= SHORT_LIST)]).tolist():
                a, b = np.triu_indices(n, 1)
                at = begin[length == n][:, None]
                left.append((at + a).ravel())
                right.append((at + b).ravel())
            for at, n in zip(begin[length > SHORT_LIST].tolist(), length[length > SHORT_LIST].tolist()):
                star.append(np.stack([np.full(n - 1, at), np.arange(at + 1, at + n)]))
            x, y = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (left, right))
            near = (size[x].astype(np.int64) * den >= size[y].astype(np.int64) * num) & (size[y].astype(np.int64) * den >= size[x].astype(np.int64) * num)
            x, y = x[near], y[near]
            s = np.concatenate([np.empty((2, 0), np.int64), *star], axis=1)
            n = np.concatenate([np.ones(len(x), np.int32), np.full(s.shape[1], -1, np.int32)])
            x, y = np.concatenate([x, s[0]]), np.concatenate([y, s[1]])
            if not len(x):
                return None
            return pa.RecordBatch.from_arrays([_ints(np.minimum(fp[x], fp[y])), _ints(np.maximum(fp[x], fp[y])), _ints(np.minimum(size[x], size[y]), np.int32), _ints(n, np.int32)], names=["u", "v", "size", "n"])

        rest: list[np.ndarray] | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                now = [np.concatenate(z) for z in zip(rest, now)]
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last list may go on
            if len(now[0]) - cut > 100_000:  # a list too long to hold: every part keeps its first entry
                cut = len(now[0]) - 1
                part = pairs(*now)
                rest = [z[np.searchsorted(now[0], now[0][-1]) :][:1] for z in now]
            else:
                part = pairs(*[z[:cut] for z in now]) if cut else None
                rest = [z[cut:] for z in now]
            if part is not None:
                yield part
        if rest is not None and len(rest[0]):
            part = pairs(*rest)
            if part is not None:
                yield part

    return run


def candidates(first: DataFrame, t: Threshold) -> DataFrame:
    """``u, v``: a graph whose components hold every pair of classes that may link."""
    parts = shuffle_partitions(first.sparkSession)
    lists = first.where("not frequent").select("shingle", "fp", "size").repartition(parts, "shingle").sortWithinPartitions("shingle", "fp")
    found = lists.mapInArrow(_list_pairs(t.num, t.den), "u long, v long, size int, n int")
    star = F.max(F.col("n") < 0)
    least = F.expr(f"(size * {t.num}L + {t.den - 1}) div {t.den}")  # of the smaller set
    counted = found.groupBy("u", "v").agg(F.sum("n").alias("n"), F.min("size").alias("size"), star.alias("star"))
    kept = counted.where(F.col("star") | (F.col("n") >= F.greatest(F.lit(1), F.floor((F.col("size") - least) / 2)))).select("u", "v")
    often = saved(first.where("frequent").select("shingle", "fp").distinct())
    centre = often.groupBy("shingle").agg(F.min("fp").alias("u"))
    stars = often.join(centre, "shingle").where("u <> fp").select("u", F.col("fp").alias("v")).distinct()
    return kept.unionByName(stars)


def divide_skip(sets: list[np.ndarray], t: Threshold) -> list[tuple[int, int]]:
    """Links between distinct sets that join all linked ones (a spanning forest of each
    component).  Sets are probed by ascending size against the lists of those before."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    lists: dict[int, list[int]] = defaultdict(list)
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, sizes = [], [len(sets[i]) for i in order]
    repeated = np.unique(np.concatenate(sets), return_counts=True) if sets else None
    shared = set(repeated[0][repeated[1] > 1].tolist()) if sets else set()
    for q, i in enumerate(order):
        tokens = [x for x in sets[i].tolist() if x in shared]
        size, floor = sizes[q], t.least(sizes[q])
        low = bisect_left(sizes, floor)  # smaller ones can't link
        need = t.overlap(size, floor)
        mine = sorted((x for x in map(lists.get, tokens) if x and x[-1] >= low), key=len)
        if len(mine) >= need:
            n_long = min(need - 1, int(need / (MU * math.log2(len(mine[-1]) + 1) + 1)))
            short, long = mine[: len(mine) - n_long], mine[len(mine) - n_long :]
            for j, common in _merge_counts(short, low, need - n_long):
                if find(i) == find(order[j]):
                    continue
                least = t.overlap(size, sizes[j])
                for rank, ids in enumerate(reversed(long)):
                    if common + n_long - rank < least:
                        break
                    at = bisect_left(ids, j)
                    common += at < len(ids) and ids[at] == j
                if t.linked(common, size, sizes[j]):
                    links.append((i, order[j]))
                    root[find(i)] = find(order[j])
        for x in tokens:
            lists[x].append(q)
    return links


def _merge_counts(lists: list[list[int]], low: int, need: int) -> Iterator[tuple[int, int]]:
    """Ids from ``low`` on that stand in at least ``need`` of the sorted lists, with the
    number; a heap holds the next id of every list."""
    heap = [(x[at], at, x) for x in lists if (at := bisect_left(x, low)) < len(x)]
    heapq.heapify(heap)
    while len(heap) >= need:
        now, n = heap[0][0], 0
        while heap and heap[0][0] == now:
            _, at, x = heap[0]
            n += 1
            if at + 1 < len(x):
                heapq.heapreplace(heap, (x[at + 1], at + 1, x))
            else:
                heapq.heappop(heap)
        if n >= need:
            yield now, n


def _group_links(num: int, den: int):
    t = Threshold(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps, sets = None, [], []

        def links() -> pa.RecordBatch | None:
            found = divide_skip(sets, t)
            if not found:
                return None
            return pa.RecordBatch.from_arrays([_ints([fps[a] for a, _ in found]), _ints([fps[b] for _, b in found])], names=["u", "v"])

        for batch in batches:
            rows = zip(batch.column("grp").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("fp").to_pylist(), batch.column("shingles").to_pylist())
            for *now, fp, data in rows:
                if now != key:
                    if len(sets) > 1 and (part := links()) is not None:
                        yield part
                    key, fps, sets = now, [], []
                if not fps or fps[-1] != fp:
                    fps.append(fp)
                    sets.append(np.frombuffer(data, np.uint64))
        if len(sets) > 1 and (part := links()) is not None:
            yield part

    return run


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(SLOTS))


def links(docs: DataFrame, table: DataFrame, groups: DataFrame, k: int, t: Threshold) -> DataFrame:
    """``u, v``: links between classes that join all linked ones.  ``table``: ``classes``;
    ``groups``: ``node, component`` of the candidates."""
    reps = table.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"))
    members = saved(groups.join(reps, groups["node"] == reps["fp"]).select("doc_id", "fp", "size", F.col("component").alias("grp")))
    total = members.groupBy("grp").agg(F.sum("size").alias("total"), F.count("*").alias("n")).where("n > 1")
    blocks = total.select("grp", F.ceil(F.col("total") / GROUP_SHINGLES).cast("int").alias("blocks"))
    members = members.join(blocks, "grp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in arrow_rows(batches, 1, HASH_BYTES):
            sets, fps = shingle_sets(texts, k), batch.column(0).to_pylist()
            own = [i for i, s in enumerate(sets) if len(s) and fingerprint(s) == fps[i]]  # an id may have other texts too
            part = batch.take(pa.array(own, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array([sets[i].tobytes() for i in own], pa.binary())], names=["fp", "grp", "blocks", "shingles"])

    members = members.withColumnRenamed("doc_id", "rep_id").drop("size")
    near = docs.select("doc_id", "text", _slot(F.col("doc_id")).alias("slot"))
    marked = np.zeros(SLOTS, bool)
    marked[members.select(_slot(F.col("rep_id")).alias("slot")).distinct().toPandas()["slot"].to_numpy(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marked))  # of fixed size; only spares texts the shuffle

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.select([0, 1]).filter(pa.array(marked[batch.column(2).to_numpy()]))

    docs = near.mapInArrow(maybe, "doc_id long, text string")
    texts = docs.join(members, F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("fp", "text", "grp", "blocks")
    sets = texts.mapInArrow(run, "fp long, grp long, blocks int, shingles binary")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks") <= 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("own"))))
    dealt = sets.withColumn("own", own).withColumn("other", other)
    dealt = dealt.select("grp", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", "shingles")
    dealt = dealt.repartition(shuffle_partitions(docs.sparkSession), "grp", "a", "b").sortWithinPartitions("grp", "a", "b", "fp")
    return dealt.mapInArrow(_group_links(t.num, t.den), "u long, v long")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (``doc_id, text``)."""
    t = Threshold(num, den)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = saved(classes(rows, k))
    spark = docs.sparkSession
    often = frequent_shingles(rows, k, table.count())  # bounded by the sample
    often = with_long_lists(first_shingles(rows, k, t, spark.sparkContext.broadcast(often)), often)
    first = first_shingles(rows, k, t, spark.sparkContext.broadcast(often))
    groups = connected_components(candidates(first, t))
    comps = connected_components(links(rows, table, groups, k, t))
    reps = table.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("least"))
    reps = reps.join(comps, reps["fp"] == comps["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    labels = reps.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = reps.join(labels, "component").select("fp", "component_id")
    return table.join(labels, "fp", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
