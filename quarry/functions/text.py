"""Prompt formatting, vocabulary, tokenisation and padding.

Tokens are whitespace-separated words of the lower-cased text.  The
vocabulary is built with a distributed ``groupBy`` count and an exact
distributed rank; tokens are looked up inside the row in a broadcast
vocabulary whose size was checked to be small, or joined with a larger one.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.joins import lookup
from quarry.operators.keys import rank_by
from quarry.operators.layout import spread

from quarry.fixed import (  # noqa: E402
    ANSWER_PREFIX,
    IGNORE_INDEX,
    INPUT_HEADER,
    INSTRUCTION_HEADER,
    PAD_MULTIPLE,
    PADDED_LENGTH,
    QUESTION_PREFIX,
    RESPONSE_HEADER,
    SECTION_BREAK,
)

# Special tokens of our vocabulary, in id order.
PAD, UNK, BOS, EOS = "<pad>", "<unk>", "<s>", "</s>"
DEFAULT_SPECIALS = (PAD, UNK, BOS, EOS)

TOKEN_SPLIT = r"[ \t\r\n]+"


def _py_text(c: Column) -> Column:
    """A value as a Python f-string would show it (``None`` for NULL)."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _required(c: Column, what: str) -> Column:
    """NULL is an error, as concatenating ``None`` is in Python."""
    return F.when(c.isNull(), F.raise_error(F.lit(f"prompt formatting: NULL {what}"))).otherwise(c)


def prompt_expr(columns: list[str], eos: str = EOS) -> Column:
    """The formatted training text; the branch is picked from the columns.

    (a) ``instruction`` + ``output`` (``input`` section only when non-empty),
    (b) ``question`` + ``answer``, (c) ``text``, (d) the whole row as JSON.
    """
    cols = set(columns)
    if {"instruction", "output"} <= cols:
        inp = F.coalesce(F.col("input").cast("string"), F.lit("")) if "input" in cols else F.lit("")
        input_part = F.when(inp != "", F.concat(F.lit(INPUT_HEADER), inp, F.lit(SECTION_BREAK))).otherwise(F.lit(""))
        return F.concat(
            F.lit(INSTRUCTION_HEADER),
            _py_text(F.col("instruction")),
            F.lit(SECTION_BREAK),
            input_part,
            F.lit(RESPONSE_HEADER),
            _required(F.col("output").cast("string"), "output"),
            F.lit(eos),
        )
    if {"question", "answer"} <= cols:
        return F.concat(
            F.lit(QUESTION_PREFIX), _py_text(F.col("question")), F.lit(ANSWER_PREFIX), _py_text(F.col("answer")), F.lit(eos)
        )
    if "text" in cols:
        return F.concat(_required(F.col("text").cast("string"), "text"), F.lit(eos))
    return F.concat(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}), F.lit(eos))


def format_prompt(df: DataFrame, eos: str = EOS, keep: list[str] | None = None) -> DataFrame:
    """Replace all columns by one ``text`` column (plus any ``keep`` columns)."""
    keep = keep or []
    data_cols = [c for c in df.columns if c not in keep]
    return df.select(*keep, prompt_expr(data_cols, eos).alias("text"))


def words(text) -> Column:
    """Lower-cased whitespace tokens, empty strings removed (no lambda: stays in codegen)."""
    t = text if isinstance(text, Column) else F.col(text)
    return F.array_remove(F.split(F.lower(t), TOKEN_SPLIT), "")


def marked_words(text, eos: str = EOS) -> Column:
    """``words``, with every end-of-sequence marker a word of its own.  Vocabulary and
    tokenisation both split with it, so that they agree on every token."""
    t = text if isinstance(text, Column) else F.col(text)
    return words(F.regexp_replace(t, F.lit(_regex_quote(eos)), F.lit(f" {eos} ")))


@dataclass(frozen=True)
class Vocab:
    """Token table ``(token string, id bigint)`` plus the special ids."""

    table: DataFrame
    size: int
    pad_id: int
    unk_id: int
    bos_id: int
    eos_id: int


def build_vocab(df: DataFrame, text_col: str = "text", max_size: int | None = None, specials=DEFAULT_SPECIALS) -> Vocab:
    """Specials first, then tokens by (count desc, token asc), numbered densely.

    The token counts are a ``groupBy`` with map-side partial aggregation, so a
    hot word costs one row per partition in the shuffle.  If ``<pad>`` is not
    among the specials, padding uses the end-of-sequence id.
    """
    spark = df.sparkSession
    counts = (
        spread(df.select(text_col))
        .select(F.explode(marked_words(text_col)).alias("token"))
        .where(~F.col("token").isin(list(specials)))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = [F.col("n").desc(), F.col("token").asc()]
    if max_size is None:
        ranked = rank_by(counts, order, "rank")
    else:
        ranked = rank_by(_top_tokens(counts, max(max_size - len(specials), 0)), order, "rank")
    n_sp = len(specials)
    words_tab = ranked.select("token", (F.col("rank") + n_sp).alias("id"))
    special_tab = spark.createDataFrame([(s, i) for i, s in enumerate(specials)], "token string, id bigint")
    table = special_tab.unionByName(words_tab)
    size = n_sp + words_tab.count()
    ids = {s: i for i, s in enumerate(specials)}
    eos_id = ids.get(EOS, n_sp - 1)
    return Vocab(
        table=table,
        size=size,
        pad_id=ids.get(PAD, eos_id),
        unk_id=ids.get(UNK, eos_id),
        bos_id=ids.get(BOS, eos_id),
        eos_id=eos_id,
    )


def _top_tokens(counts: DataFrame, budget: int) -> DataFrame:
    """The ``budget`` first tokens by (count desc, token asc), without ranking all tokens.

    The counts are materialised once; the distribution of count values (one
    row per distinct count, small) gives the count ``n*`` at which the budget
    is reached; every token above ``n*`` is kept, and among the tokens tied at
    ``n*`` (possibly very many rare words) only the alphabetically first
    ``r <= budget`` are taken by a bounded top-k.
    """
    from pyspark.sql import Window

    from quarry.operators.layout import materialize

    if budget <= 0:
        return counts.limit(0)
    counts = materialize(counts)
    by_n = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    w = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = by_n.withColumn("cum", F.sum("k").over(w))  # one row per distinct count value
    hit = cum.where(F.col("cum") >= budget).orderBy(F.col("n").desc()).limit(1).collect()
    if not hit:
        return counts  # fewer tokens than the budget
    n_star, k_star, cum_star = int(hit[0]["n"]), int(hit[0]["k"]), int(hit[0]["cum"])
    above = cum_star - k_star
    ties = counts.where(F.col("n") == n_star).orderBy("token").limit(budget - above)
    return counts.where(F.col("n") > n_star).unionByName(ties)


# Vocabularies up to both sizes are looked up inside the row; larger ones are joined.
IN_ROW_TOKENS, IN_ROW_BYTES = 500_000, 32 << 20
# Larger vocabularies are joined hot/cold: the most frequent ids are broadcast.
HOT_VOCAB_IDS = 100_000


def _small(vocab: Vocab) -> bool:
    if vocab.size > IN_ROW_TOKENS:
        return False
    return (vocab.table.agg(F.sum(F.octet_length("token"))).first()[0] or 0) <= IN_ROW_BYTES


def _ids_in_row(df: DataFrame, vocab: Vocab, key: str, tokens: Column) -> DataFrame:
    """``(key, ids)`` from a broadcast of the whole vocabulary, whose size was checked: no shuffle."""
    from quarry.operators.batches import map_batches

    shared = df.sparkSession.sparkContext.broadcast({r["token"]: r["id"] for r in vocab.table.select("token", "id").collect()})
    unk = vocab.unk_id

    def look_up(batch: pa.RecordBatch, known: dict[str, int]) -> pa.RecordBatch:
        lists = batch.column(1)
        ids = [known.get(t, unk) for t in lists.flatten().to_pylist()]
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0)).to_pylist()
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(ids, pa.int64()))], names=[key, "ids"])

    own = df.select(key, tokens.alias("_tokens"))
    schema = T.StructType([own.schema.fields[0], T.StructField("ids", T.ArrayType(T.LongType()))])
    return map_batches(own, look_up, schema, lambda: shared.value)


def token_ids(df: DataFrame, vocab: Vocab, key: str, text_col: str = "text", eos: str = EOS, limit: int | None = None) -> DataFrame:
    """``(key, ids array<bigint>)``: every token mapped to its id (unknown -> unk).

    The literal end-of-sequence marker is split off as its own token.  A vocabulary
    of checked size is broadcast and looked up in the row, without a shuffle.  For a larger one rows
    explode to ``(key, pos, token)``, join the vocabulary on ``token`` and are
    gathered again per key in position order; the grouping key is the row
    key, so no group is larger than one row's tokens.  With ``limit`` only
    the first ``limit`` tokens of a row go through the join and the gather
    (truncation is pushed before the shuffle).
    """
    rows = spread(df.select(key, text_col), key)
    if _small(vocab):
        tokens = marked_words(text_col, eos)
        return _ids_in_row(rows, vocab, key, tokens if limit is None else F.slice(tokens, 1, max(limit, 1)))
    toks = rows.select(key, F.posexplode_outer(marked_words(text_col, eos)).alias("pos", "token"))
    if limit is not None:  # the first token stays in any case, and with it the row
        toks = toks.where(F.col("pos").isNull() | (F.col("pos") < max(limit, 1)))
    # private column names so that a row key called "id" or "token" cannot collide
    vt = vocab.table.select(F.col("token").alias("_qtok"), F.col("id").alias("_qtid"))
    toks = toks.withColumnRenamed("token", "_qtok")
    # Ids are ranked by frequency, so the first HOT_VOCAB_IDS entries are the hot tokens.
    hot = vt.where(F.col("_qtid") < HOT_VOCAB_IDS)
    looked = lookup(toks, vt, ["_qtok"], vocab.size, "left", hot).select(
        key, "pos", F.when(F.col("_qtok").isNull(), F.lit(None)).otherwise(F.coalesce("_qtid", F.lit(vocab.unk_id))).alias("_qtid")
    )
    gathered = looked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "_qtid"))).alias("_p"))
    return gathered.select(key, F.array_compact(F.col("_p")["_qtid"]).alias("ids"))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def tokenise(df: DataFrame, vocab: Vocab, max_length: int | None, key: str, text_col: str = "text") -> DataFrame:
    """Truncate to ``max_length`` (``None``: whole texts), no padding; mask of ones; labels = ids."""
    ids = F.col("ids") if max_length is None else F.slice(F.col("ids"), 1, max_length)
    return token_ids(df, vocab, key, text_col, limit=max_length).select(
        key,
        ids.alias("input_ids"),
        F.transform(ids, lambda x: F.lit(1).cast("bigint")).alias("attention_mask"),
        ids.alias("labels"),
    )


def tokenise_padded(
    df: DataFrame, vocab: Vocab, max_length: int = PADDED_LENGTH, key: str = "id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``<s>`` + tokens + ``</s>`` truncated to and padded up to ``max_length``.

    Outputs ``input_ids``, ``attention_mask`` (ones then zeros) and
    ``token_type_ids`` (zeros); ``carry`` columns (e.g. the label) are kept.
    """
    body = F.slice(F.col("ids"), 1, max(max_length - 2, 0))
    ids = F.concat(F.array(F.lit(vocab.bos_id).cast("bigint")), body, F.array(F.lit(vocab.eos_id).cast("bigint")))
    ids = F.slice(ids, 1, max_length)
    n_pad = F.lit(max_length) - F.size("_ids")
    out = token_ids(df, vocab, key, text_col, limit=max(max_length - 2, 0)).select(key, ids.alias("_ids"))
    out = out.select(
        key,
        F.concat("_ids", F.array_repeat(F.lit(vocab.pad_id).cast("bigint"), n_pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1).cast("bigint"), F.size("_ids")), F.array_repeat(F.lit(0).cast("bigint"), n_pad)).alias(
            "attention_mask"
        ),
        F.array_repeat(F.lit(0).cast("bigint"), F.lit(max_length)).alias("token_type_ids"),
    )
    if carry:
        out = out.join(df.select(key, *carry), key, "inner")
    return out


def pad_batches(df: DataFrame, batch_col: str, pad_id: int, multiple: int = PAD_MULTIPLE, ids: str = "input_ids") -> DataFrame:
    """Pad each batch to its longest row rounded up to a multiple of ``multiple``.

    ``batch_col`` is a batch number (e.g. ``floor(row_idx / batch_size)``);
    the longest length is a window max per batch, so each batch is one small
    window partition.  Labels are the ids with padded positions set to -100.
    """
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch_col))
    target = (F.ceil(longest / F.lit(multiple)) * F.lit(multiple)).cast("int")
    with_t = df.withColumn("padded_len", target)
    n_pad = F.col("padded_len") - F.size(ids)
    return with_t.select(
        *[c for c in df.columns if c not in (ids, "attention_mask", "labels")],
        F.concat(F.col(ids), F.array_repeat(F.lit(pad_id).cast("bigint"), n_pad)).alias(ids),
        F.concat(F.array_repeat(F.lit(1).cast("bigint"), F.size(ids)), F.array_repeat(F.lit(0).cast("bigint"), n_pad)).alias(
            "attention_mask"
        ),
        F.concat(F.col(ids), F.array_repeat(F.lit(IGNORE_INDEX).cast("bigint"), n_pad)).alias("labels"),
        "padded_len",
    )
