"""Packing of token pieces into sequences: first-fit decreasing per randomised group.

Texts are encoded once, inside the tasks that read them; what leaves those tasks is one
small row per piece (no token ids).  A document is cut into full pieces of ``seq_len``
ids and one rest.  A full piece is a sequence of its own.  The rests are dealt at random
into groups of about ``group_rows`` and each group is packed by first-fit decreasing,
where a tournament tree over the bins' free room finds the leftmost bin that fits in
O(log bins).  Groups are independent tasks, their number grows with the input.

Defined cases: a null or empty text is the end id alone; repeated rows are packed once
each; a null id is kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import kept_in_stage, map_rows, saved

#: Chunks kept per worker with their ids, before the cache starts anew.
CACHE_ENTRIES = 400_000

#: Fixed value: the pattern of the byte-level pre-tokeniser.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Punctuation that often closes a word.
CLOSING = ".,;:!?"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _byte_pair(tokenizer) -> Callable[[str], list[int]]:
    """The tokenizer's ``encode`` without its overhead on short texts.  A byte-level
    vocabulary whose ids follow its merges (checked) can be merged by rank, with the
    pre-tokeniser's pattern; any other is left to the tokenizer itself."""
    import json

    import tiktoken

    parts = json.loads(tokenizer.to_str())
    model, pre = parts["model"], parts.get("pre_tokenizer") or {}
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves, the others from 256 on
    byte = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in seen)}
    vocab, merges = model.get("vocab"), [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges") or ()]
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not parts.get("normalizer")
    if not plain or not merges or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or sorted(vocab.get(c, -1) for c in byte) != list(range(256)):
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    ranks = {bytes([byte[c] for c in w]): i for w, i in vocab.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("chunks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class _Chunks(dict):
    """Ids, as little-endian uint32 bytes, of a chunk between single spaces, with the space
    before it.  Letters never join with closing punctuation, so both are looked up apart.
    A chunk that borders on more white space raises."""

    def __init__(self, ids: Callable[[str], bytes]):
        self.ids, self.closing = ids, {c: ids(c) for c in CLOSING}

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise KeyError(chunk)
        if chunk[-1] in self.closing and chunk[:-1].isalpha():
            got = self[chunk[:-1]] + self.closing[chunk[-1]]
        else:
            got = self.ids(" " + chunk)
        self[chunk] = got
        return got


@kept_in_stage
def _encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Texts to their ids as little-endian uint32 bytes.

    The pre-tokeniser never joins what stands on the two sides of a single space, except
    that the space leads the right side.  So ids are kept per chunk between single spaces;
    a text with a chunk that borders on more white space is encoded whole.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    pairs = _byte_pair(tokenizer)
    ids = lambda text: array("I", pairs(text)).tobytes()
    chunks = _Chunks(ids)

    def one(text: str) -> bytes:
        cut = text.split(" ")
        if len(cut) < 3 or not cut[0] or cut[0][-1].isspace() or not cut[-1] or cut[-1][0].isspace():
            return ids(text)
        try:
            return b"".join([ids(cut[0]), *map(chunks.__getitem__, cut[1:-1]), ids(" " + cut[-1])])
        except KeyError:  # white space meets white space
            return ids(text)

    def encode(texts: list[str]) -> list[bytes]:
        if len(chunks) > CACHE_ENTRIES:
            chunks.clear()
        return [one(t) for t in texts]

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: full pieces of ``seq_len`` ids, then the rest.  ``piece`` is a
    number unique among the rows."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def make():
        from pyspark import TaskContext

        encode, task, made = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0

        def step(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
            nonlocal made
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in texts])):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, seq_len):
                    stop = min(n, start + seq_len)
                    rows.append((doc_id, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), n, (task << 36) + made))
                    made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"])

        return step

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), make, PIECES)


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item.  The tree's leaves are the bins' free room, each inner
    node the larger of its two; the leftmost fitting bin is found from the root."""
    n = len(lengths)
    width = 1 << max(0, (n - 1).bit_length())
    tree = [room] * (2 * width)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[item]), 1
        while node < width:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - width, room - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = 1024, group_rows: int = 4096, seed: int = 7) -> DataFrame:
    """Columns of ``PACKED``, one row per piece; see the module's text."""
    # numbered by task, so they are written down before anything depends on the numbers
    pieces = saved(token_pieces(docs, tokenizer_path, seq_len))
    full = pieces.where(F.col("length") == seq_len)
    rest = pieces.where(F.col("length") < seq_len)
    groups = max(1, -(-rest.count() // group_rows))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece", ignore_index=True)
        bins, rows["offset"] = first_fit_decreasing(rows["length"].to_numpy(), seq_len)
        rows["sequence_id"] = (int(key[0]) * (1 << 30) + bins) * 2
        return rows[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("piece", F.lit(seed)), F.lit(groups)))
    packed = dealt.groupBy("grp").applyInPandas(one, PACKED)
    alone = full.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(packed)
