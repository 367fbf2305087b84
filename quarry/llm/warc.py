"""WARC archives written and read by Spark, and their index merged externally.

``write_archive`` makes one record per page: the first page (smallest id) of equal
payloads is a response, the others revisit it and carry its HTTP header only.  Files are
written by Spark's own text writer (a record ends with the two line ends that WARC asks
for), so they reach whatever store the folder is in.  ``read_archive`` parses every file
in the tasks that read it and yields, per file, a capture run sorted by url key, time and
id.  ``merge_runs`` cuts the runs at common range bounds of that whole key (so one url
with very many captures is cut too) and merges the pieces of each range with a loser
tree: read by range and position, the captures are in global order.

Defined cases: null html is an empty payload; a null url has an empty key; line ends and
blanks in an url are percent-coded; a null id is kept and refers like any other; rows
that repeat the smallest id are responses all; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.session import ensure_checkpoint_dir

END = "\r\n"
#: A file holds records of about so many bytes before compression.
FILE_BYTES = 24 << 20
#: Payload digests up to this many (48 bytes each) are broadcast, beyond it only those of very large groups.
BROADCAST_DIGESTS = 100_000
HOT_SHARE = 1000

RUN = "run long, page_id long, url_key string, captured_at string, record_type string, payload_bytes long, payload_digest string, refers_to long"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(digest: Column) -> Column:
    """A 40-digit hexadecimal digest in base 32: five digits are four."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_first(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, first``: ``first`` is the smallest id of that payload,
    null where no other page has it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    firsts = saved(rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    size = firsts.agg(F.count("*").alias("digests"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if size["digests"] <= BROADCAST_DIGESTS:
        return rows.join(F.broadcast(firsts.drop("n")), "digest", "left")
    hot = firsts.where(F.col("n") * HOT_SHARE >= size["rows"]).drop("n")  # HOT_SHARE rows at most
    rows = rows.join(F.broadcast(hot.withColumnRenamed("first", "hot_first")), "digest", "left")
    cold = rows.where("hot_first is null").drop("hot_first").join(firsts.drop("n"), "digest", "left")
    return cold.unionByName(rows.where("hot_first is not null").withColumnRenamed("hot_first", "first"))


def write_archive(pages: DataFrame, path: str) -> None:
    rows = with_first(pages)
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A"), " ", "%20")
    when = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0)) % 100_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.octet_length("html").cast("string"), F.lit(END + END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{END}WARC-Record-ID: "), name(F.col("page_id")),
        F.lit(f"{END}WARC-Target-URI: "), url,
        F.lit(f"{END}WARC-Date: "), when,
        F.lit(f"{END}WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"{END}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{END}WARC-Refers-To: "), name(F.col("first")))).otherwise(F.lit("")),
        F.lit(f"{END}Content-Type: application/http; msgtype=response{END}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END),
    )
    records = rows.select(F.concat(head, block).alias("value"))
    records.write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + 600)))).text(path)


def url_key(url: str) -> str:
    """Host parts in reverse order, then the rest: urls of a domain stand together."""
    _, found, rest = url.partition("://")
    if not found:
        return url
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of every record; raises where the file isn't well formed."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split(END)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record begins at byte {at}")
        header = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        begin = stop + 4
        at = begin + int(header["Content-Length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at} isn't ended")
        yield header, data[begin:at]
        at += 4


def _id(name: str) -> int | None:
    text = name[len("<urn:page:") : -1]
    return None if text == "none" else int(text)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``RUN``: per file a run of its captures, sorted by url key, time and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column(0).to_pylist()):
                rows = []
                data = zlib.decompress(memoryview(batch.column(1)[i].as_buffer()), 31)
                for header, block in records_of(data):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, refers = header["WARC-Payload-Digest"].removeprefix("sha1:"), header.get("WARC-Refers-To")
                    if refers is None:
                        size = len(payload)
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"payload of {header['WARC-Record-ID']} doesn't have its digest")
                    else:
                        size = int(http.decode().rpartition("Content-Length: ")[2])
                    rows.append((url_key(header["WARC-Target-URI"]), header["WARC-Date"], _id(header["WARC-Record-ID"]), header["WARC-Type"], size, digest, None if refers is None else _id(refers)))
                rows.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
                for at in range(0, len(rows), 10_000):
                    part = rows[at : at + 10_000]
                    key, date, page, kind, size, digest, refers = zip(*part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([zlib.crc32(name.encode())] * len(part), pa.int64()), pa.array(page, pa.int64()), pa.array(key), pa.array(date), pa.array(kind), pa.array(size, pa.int64()), pa.array(digest), pa.array(refers, pa.int64())],
                        names=["run", "page_id", "url_key", "captured_at", "record_type", "payload_bytes", "payload_digest", "refers_to"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RUN)  # files are read where they are parsed


def loser_tree_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Items of sorted runs in order, the earlier run first on a tie.  Inner nodes keep the
    loser of their match, node 0 the winner; a winner's successor replays its path only."""
    k = len(runs)
    if not k:
        return
    at = [0] * k
    key = [(0, r[0], i) if r else (1, (), i) for i, r in enumerate(runs)]
    winners, tree = [0] * k + list(range(k)), [0] * k
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (a, b) if key[a] < key[b] else (b, a)
    tree[0] = winners[1] if k > 1 else 0
    while key[best := tree[0]][0] == 0:
        yield runs[best][at[best]]
        at[best] += 1
        key[best] = (0, runs[best][at[best]], best) if at[best] < len(runs[best]) else (1, (), best)
        node, now = (best + k) // 2, best
        while node > 0:
            if key[tree[node]] < key[now]:
                now, tree[node] = tree[node], now
            node //= 2
        tree[0] = now


def merge_runs(runs: DataFrame, rows_per_range: int = 50_000) -> DataFrame:
    """``runs`` in global order: ``shard`` is the range, ``position`` the place in it."""
    runs = saved(runs)  # the bounds are drawn from it, and its rows must stay as they are
    count = runs.count()
    order = ["url_key", "captured_at", "page_id"]
    ranged = runs.repartitionByRange(max(1, -(-count // rows_per_range)), *order).sortWithinPartitions("run", *order)
    names = runs.columns

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        by_run: dict[int, list[tuple]] = {}
        kept: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                r = dict(zip(names, row))
                by_run.setdefault(r["run"], []).append((r["url_key"], r["captured_at"], r["page_id"] is not None, r["page_id"] or 0, len(kept)))
                kept.append(row)
        out = [kept[item[-1]] for item in loser_tree_merge(list(by_run.values()))]
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (runs_types[n] for n in names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([TaskContext.get().partitionId()] * len(out), pa.int64()), pa.array(range(len(out)), pa.int64())], names=[*names, "shard", "position"])

    runs_types = {n: pa.string() if t == "string" else pa.int64() for n, t in runs.dtypes}
    return ranged.mapInArrow(merge, RUN + ", shard long, position long")


def captures(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared folder, reads the archive back and merges its index."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4()}"
    write_archive(pages, path)
    return merge_runs(read_archive(spark, path))
