"""Registered queries over the generated test tables, each with a DuckDB oracle.

Stand-ins (see FIXTURES.md): *housing* = ``lineitem`` (features
``l_quantity, l_discount, l_tax, l_linenumber``, target ``l_extendedprice``);
*ratings* = ``lineitem`` joined to ``orders`` (user ``o_custkey``, item
``l_partkey``, rating ``ceil(l_quantity / 10)``); *instructions* = a user turn
and the next assistant turn of ``conversations``; *sentences* = ``documents``
(label ``lang = 'en'``) and ``documents`` joined to ``labels``.

Every query reads whole tables.  Arrays are emitted as joined strings so the
comparison does not depend on list formatting; floating results that depend
on summation order are rounded in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import columns as P
from quarry.operators import indexing as A
from quarry.operators import sampling as X
from quarry.operators.keys import with_hash_key
from quarry.sources.readers import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- stand-ins

HOUSING_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def li_key():
    """Unique key of ``lineitem`` at every scale (five columns)."""
    return [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_shipdate").cast("date")]


LI_KEY_SQL = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE))"


def sql_hash(key_sql: str, seed) -> str:
    """DuckDB form of ``keys.seeded_hash``."""
    return f"('0x' || substr(md5(concat_ws('|', {key_sql}, '{seed}')), 1, 15))::BIGINT"


def housing(spark, d) -> DataFrame:
    """Prepared housing stand-in: rename target, select in order, cast all to float."""
    li = table(spark, d, "lineitem")
    cols = P.parse_columns(",".join(HOUSING_FEATURES + ["target"]))
    df = P.rename(li, {"l_extendedprice": "target"})
    keyed = df.select(*[c for c in LI_KEY_KEEP if c not in cols], *cols)
    return P.cast_float(keyed, cols)


def housing_key():
    """Key of the housing stand-in after the float cast (``l_linenumber`` is a float there)."""
    return [
        F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber").cast("int"), F.col("l_shipdate").cast("date")
    ]


LI_KEY_KEEP = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
HOUSING_SQL_CAST = (
    "CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_discount AS FLOAT) AS l_discount, "
    "CAST(l_tax AS FLOAT) AS l_tax, CAST(l_linenumber AS FLOAT) AS l_linenumber, "
    "CAST(l_extendedprice AS FLOAT) AS target"
)


# ------------------------------------------------------- projections (2.3)


@query(
    "select_rename_cast",
    f"SELECT {HOUSING_SQL_CAST} FROM lineitem",
)
def q_select_rename_cast(spark, d):
    li = table(spark, d, "lineitem")
    cols = P.parse_columns("l_quantity,l_discount,l_tax,l_linenumber,target")
    return P.cast_float(P.select_columns(P.rename(li, {"l_extendedprice": "target"}), cols), cols)


@query(
    "drop_if_present",
    "SELECT l_quantity, l_discount, l_tax, l_extendedprice AS label_value, 'l_extendedprice' AS label_name, "
    "'l_quantity,l_discount,l_tax' AS feature_names FROM lineitem",
)
def q_drop_if_present(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("uuid"), "l_quantity", "l_discount", "l_tax",
        F.col("l_shipdate").cast("date").cast("string").alias("datestr"), "l_extendedprice",
    )
    df = P.drop_if_present(li, ["uuid", "datestr"])
    feats, label = P.infer_label(df)
    return df.select(
        *feats, F.col(label).alias("label_value"), F.lit(label).alias("label_name"), F.lit(",".join(feats)).alias("feature_names")
    )


@query(
    "normalise_rating",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    "CAST(ceil(l_quantity / 10) AS BIGINT) AS rating, "
    "CAST((CAST(CAST(ceil(l_quantity / 10) AS BIGINT) AS FLOAT) - CAST(1 AS FLOAT)) / CAST(4 AS FLOAT) AS FLOAT) AS rating_norm "
    "FROM lineitem",
)
def q_normalise_rating(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.ceil(F.col("l_quantity") / 10).cast("bigint").alias("rating")
    )
    return P.normalise(li, "rating", 1.0, 5.0, "rating_norm")


@query(
    "assemble_features",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    "array_to_string([CAST(l_quantity AS FLOAT), CAST(l_discount AS FLOAT), CAST(l_tax AS FLOAT), CAST(l_linenumber AS FLOAT)]::VARCHAR[], ',') AS features "
    "FROM lineitem",
)
def q_assemble_features(spark, d):
    li = table(spark, d, "lineitem")
    out = P.assemble(li, HOUSING_FEATURES)
    return out.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.array_join(F.col("features").cast("array<string>"), ",").alias("features"),
    )


# ------------------------------------------------- sampling & splits (2.4)

_HASHED_LI = (
    "WITH k AS (SELECT *, " + LI_KEY_SQL + " AS kt FROM lineitem), "
    "h AS (SELECT *, {hash} AS h FROM k), "
    "r AS (SELECT *, row_number() OVER (ORDER BY h, kt) AS rn, count(*) OVER () AS n FROM h) "
)


def _hashed_li(seed) -> str:
    return _HASHED_LI.replace("{hash}", sql_hash("kt", seed))


@query(
    "train_test_split",
    _hashed_li(1)
    + "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice AS FLOAT) AS target, "
    "CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM r",
)
def q_train_test_split(spark, d):
    df = housing(spark, d)
    parts = X.train_test_labelled(df, 0.25, key=housing_key(), seed=1)
    return parts.select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "target", "split")


@query(
    "permutation_split",
    _hashed_li(42)
    + "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    "CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM r",
)
def q_permutation_split(spark, d):
    li = table(spark, d, "lineitem").select(*LI_KEY_KEEP)
    return X.train_test_labelled(li, 0.2, key=li_key(), seed=42).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "split"
    )


@query(
    "sequential_split",
    "WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders) "
    "SELECT o_orderkey, o_totalprice, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' "
    "WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) + CAST(floor(n * 0.1) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM r",
)
def q_sequential_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return X.split_column(X.sequential_split(orders, ["o_orderkey"]))


@query(
    "sample_n",
    "WITH h AS (SELECT o_orderkey, o_custkey, " + sql_hash("o_orderkey", 42) + " AS h, CAST(o_orderkey AS VARCHAR) AS kt FROM orders) "
    "SELECT o_orderkey, o_custkey FROM h ORDER BY h, kt LIMIT 1000",
)
def q_sample_n(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return X.sample_n(orders, 1000, key="o_orderkey", seed=42)


@query(
    "sample_capped",
    "SELECT o_orderkey, o_custkey FROM orders",
)
def q_sample_capped(spark, d):
    """A cap above the row count keeps every row."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return X.sample_capped(orders, 10**12, key="o_orderkey", seed=1)


@query(
    "sample_fraction",
    "SELECT doc_id, n_chars FROM documents WHERE "
    + sql_hash("CAST(doc_id AS VARCHAR)", 1)
    + " < CAST(0.1 * power(2, 60) AS BIGINT)",
)
def q_sample_fraction(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    return X.sample_fraction(docs, 0.1, key="doc_id", seed=1)


@query(
    "head_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def q_head_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return X.head(orders, 100, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query(
    "renumbered_rows",
    _hashed_li(1)
    + "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, rn - 1 AS row_idx FROM r",
)
def q_renumbered_rows(spark, d):
    li = table(spark, d, "lineitem").select(*LI_KEY_KEEP)
    keyed = with_hash_key(li, li_key(), 1)
    return X.renumber_hashed(keyed, "row_idx").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "row_idx")


@query(
    "renumbered_by_order",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx FROM orders",
)
def q_renumbered_by_order(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return X.renumber(orders, ["o_orderdate", "o_orderkey"], "row_idx").select("o_orderkey", "row_idx")


# -------------------------------------------------------- indexing (2.5)

_RATINGS_SQL = (
    "ratings AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, "
    "CAST(ceil(l.l_quantity / 10) AS BIGINT) AS rating, l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate "
    "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
)


def ratings(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.ceil(F.col("l_quantity") / 10).cast("bigint").alias("rating"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
    )


@query(
    "dense_index",
    "SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_idx "
    "FROM (SELECT DISTINCT o_custkey AS user_id FROM orders)",
)
def q_dense_index(spark, d):
    users = table(spark, d, "orders").select(F.col("o_custkey").alias("user_id"))
    return A.dense_index(users, "user_id", "user_idx")


@query(
    "apply_index",
    "WITH " + _RATINGS_SQL + ", "
    "u AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM ratings)), "
    "i AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM ratings)) "
    "SELECT r.l_orderkey, r.l_linenumber, r.l_suppkey, u.user_idx, i.item_idx, "
    "CAST((CAST(r.rating AS FLOAT) - CAST(1 AS FLOAT)) / CAST(4 AS FLOAT) AS FLOAT) AS rating_norm "
    "FROM ratings r JOIN u ON r.user_id = u.user_id JOIN i ON r.item_id = i.item_id",
)
def q_apply_index(spark, d):
    r = ratings(spark, d)
    uidx = A.dense_index(r, "user_id", "user_idx")
    iidx = A.dense_index(r, "item_id", "item_idx")
    out = A.apply_index(A.apply_index(r, uidx, "user_id"), iidx, "item_id")
    out = P.normalise(out, "rating", 1.0, 5.0, "rating_norm")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "user_idx", "item_idx", "rating_norm")


@query(
    "catalog_sizes",
    "WITH " + _RATINGS_SQL + " SELECT count(DISTINCT user_id) AS num_users, count(DISTINCT item_id) AS num_items FROM ratings",
)
def q_catalog_sizes(spark, d):
    return A.catalog_sizes(ratings(spark, d), {"num_users": "user_id", "num_items": "item_id"})


@query(
    "split_summary",
    _hashed_li(1)
    + ", s AS (SELECT CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train' ELSE 'validation' END AS split, "
    "CAST(l_extendedprice AS FLOAT) AS target FROM r) "
    "SELECT split, count(*) AS n_rows, round(avg(target), 4) AS mean_target FROM s GROUP BY split",
)
def q_split_summary(spark, d):
    """Flagship: housing prep + exact seeded 75/25 split, rows and mean target per split."""
    df = housing(spark, d)
    parts = X.train_test_labelled(df, 0.25, key=housing_key(), seed=1)
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("target"), 4).alias("mean_target"))


# ------------------------------------------------------------- text (2.6)

from quarry.functions import math as M  # noqa: E402
from quarry.functions import text as TX  # noqa: E402
from quarry.operators import metrics as MT  # noqa: E402
from quarry.sources.readers import instruction_pairs  # noqa: E402

NL = "chr(10)"
SQL_SPLIT = "'[ \\t\\r\\n]+'"


def sql_words(text_sql: str) -> str:
    return f"list_filter(string_split_regex(lower({text_sql}), {SQL_SPLIT}), lambda x: x <> '')"


PAIRS_SQL = (
    "u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), "
    "a AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant'), "
    "sy AS (SELECT conv_id, turn + 1 AS turn, text FROM conversations WHERE role = 'system'), "
    "pairs AS (SELECT u.conv_id, u.turn, u.text AS instruction, coalesce(sy.text, '') AS input, a.text AS output "
    "FROM u JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn "
    "LEFT JOIN sy ON u.conv_id = sy.conv_id AND u.turn = sy.turn)"
)


def pairs_with_context(spark, d) -> DataFrame:
    """Instruction pairs whose ``input`` is a system turn right before the user turn."""
    return instruction_pairs(table(spark, d, "conversations"), with_context=True)


INSTR_PROMPT_SQL = (
    f"'### Instruction:' || {NL} || coalesce(instruction, 'None') || {NL} || {NL} || "
    f"CASE WHEN coalesce(input, '') <> '' THEN '### Input:' || {NL} || input || {NL} || {NL} ELSE '' END || "
    f"'### Response:' || {NL} || output || '</s>'"
)


@query(
    "prompt_instruction",
    "WITH " + PAIRS_SQL + f" SELECT conv_id, turn, {INSTR_PROMPT_SQL} AS text FROM pairs",
)
def q_prompt_instruction(spark, d):
    return TX.format_prompt(pairs_with_context(spark, d), keep=["conv_id", "turn"])


@query(
    "prompt_question_answer",
    "WITH " + PAIRS_SQL + f" SELECT conv_id, turn, 'Question: ' || instruction || {NL} || 'Answer: ' || output || '</s>' AS text FROM pairs",
)
def q_prompt_question_answer(spark, d):
    qa = pairs_with_context(spark, d).select(
        "conv_id", "turn", F.col("instruction").alias("question"), F.col("output").alias("answer")
    )
    return TX.format_prompt(qa, keep=["conv_id", "turn"])


@query("prompt_plain_text", "SELECT doc_id, text || '</s>' AS text FROM documents")
def q_prompt_plain_text(spark, d):
    return TX.format_prompt(table(spark, d, "documents").select("doc_id", "text"), keep=["doc_id"])


@query(
    "prompt_any_row",
    "SELECT doc_id, to_json(struct_pack(quality := quality, toxic := nullif(toxic, 0)))::VARCHAR || '</s>' AS text FROM labels",
)
def q_prompt_any_row(spark, d):
    """Rows of another shape as JSON, their NULL columns included."""
    return TX.format_prompt(table(spark, d, "labels").withColumn("toxic", F.expr("nullif(toxic, 0)")), keep=["doc_id"])


@query("project_only", "SELECT text || ' (' || lang || ')' AS line, n_chars // 2 AS half FROM documents")
def q_project_only(spark, d):
    """Mapped rows without any of their input columns."""
    docs = table(spark, d, "documents")
    line = F.concat("text", F.lit(" ("), "lang", F.lit(")"))
    return P.project_only(docs, {"line": line, "half": F.floor(F.col("n_chars") / 2)})


SPECIALS_SQL = "SELECT * FROM (VALUES ('<pad>', 0), ('<unk>', 1), ('<s>', 2), ('</s>', 3)) v(token, id)"


def marked_words_sql(text_sql: str) -> str:
    return sql_words(f"replace({text_sql}, '</s>', ' </s> ')")


def vocab_sql(text_sql: str = "text", src: str = "documents") -> str:
    return (
        f"vw AS (SELECT unnest({marked_words_sql(text_sql)}) AS token FROM {src}), "
        "vc AS (SELECT token, count(*) AS n FROM vw WHERE token NOT IN ('<pad>', '<unk>', '<s>', '</s>') GROUP BY token), "
        f"vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) - 1 + 4 AS BIGINT) AS id FROM vc "
        f"UNION ALL {SPECIALS_SQL})"
    )


def doc_vocab(spark, d) -> TX.Vocab:
    return TX.build_vocab(table(spark, d, "documents"), "text")


@query("vocabulary", "WITH " + vocab_sql() + " SELECT token, id FROM vocab")
def q_vocabulary(spark, d):
    return doc_vocab(spark, d).table


def ids_sql(src: str, key: str, text_sql: str = "text") -> str:
    """``ids(key, ids)``: token ids per row of ``src`` (needs ``vocab``)."""
    words_sql = marked_words_sql(text_sql)
    return (
        f"tw AS (SELECT {key}, {words_sql} AS w FROM {src}), "
        f"tt AS (SELECT {key}, unnest(w) AS token, unnest(generate_series(1, len(w))) AS pos FROM tw), "
        f"tl AS (SELECT tt.{key}, list(coalesce(vocab.id, 1) ORDER BY tt.pos) AS ids FROM tt LEFT JOIN vocab ON tt.token = vocab.token GROUP BY tt.{key}), "
        f"ids AS (SELECT tw.{key}, coalesce(tl.ids, []::BIGINT[]) AS ids FROM tw LEFT JOIN tl ON tw.{key} = tl.{key})"
    )


def sj(x: str) -> str:
    """SQL: list -> comma string."""
    return f"array_to_string({x}, ',')"


def aj(c) -> F.Column:
    """Spark: array -> comma string."""
    return F.array_join((F.col(c) if isinstance(c, str) else c).cast("array<string>"), ",")


@query(
    "tokenise_truncate",
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id")
    + f" SELECT doc_id, {sj('ids[1:128]')} AS input_ids, {sj('list_transform(ids[1:128], lambda x: 1)')} AS attention_mask, "
    f"{sj('ids[1:128]')} AS labels, len(ids[1:128]) AS n_tokens FROM ids",
)
def q_tokenise_truncate(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    tok = TX.tokenise(docs, doc_vocab(spark, d), 128, key="doc_id")
    return tok.select(
        "doc_id", aj("input_ids").alias("input_ids"), aj("attention_mask").alias("attention_mask"), aj("labels").alias("labels"),
        F.size("input_ids").cast("bigint").alias("n_tokens"),
    )


@query(
    "tokenise_padded",
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id")
    + ", body AS (SELECT ids.doc_id, [2::BIGINT] || ids[1:126] || [3::BIGINT] AS b FROM ids) "
    f"SELECT body.doc_id, l.quality AS label, {sj('b || list_transform(range(128 - len(b)), lambda x: 0)')} AS input_ids, "
    f"{sj('list_transform(b, lambda x: 1) || list_transform(range(128 - len(b)), lambda x: 0)')} AS attention_mask, "
    f"{sj('list_transform(range(128), lambda x: 0)')} AS token_type_ids "
    "FROM body JOIN labels l ON body.doc_id = l.doc_id",
)
def q_tokenise_padded(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    sentences = docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "inner")
    tok = TX.tokenise_padded(sentences, doc_vocab(spark, d), 128, key="doc_id", carry=["label"])
    return tok.select(
        "doc_id", "label", aj("input_ids").alias("input_ids"), aj("attention_mask").alias("attention_mask"),
        aj("token_type_ids").alias("token_type_ids"),
    )


@query(
    "pad_batches",
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id")
    + ", t AS (SELECT doc_id, ids AS x, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch FROM ids), "
    "m AS (SELECT *, CAST(ceil(max(len(x)) OVER (PARTITION BY batch) / 8) * 8 AS INTEGER) AS padded_len FROM t) "
    f"SELECT doc_id, batch, padded_len, {sj('x || list_transform(range(padded_len - len(x)), lambda i: 0)')} AS input_ids, "
    f"{sj('x || list_transform(range(padded_len - len(x)), lambda i: -100)')} AS labels, "
    f"{sj('list_transform(x, lambda i: 1) || list_transform(range(padded_len - len(x)), lambda i: 0)')} AS attention_mask FROM m",
)
def q_pad_batches(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    vocab = doc_vocab(spark, d)
    tok = TX.tokenise(docs, vocab, None, key="doc_id")
    numbered = X.renumber(tok.select("doc_id", "input_ids"), ["doc_id"], "row_idx").withColumn("batch", F.floor(F.col("row_idx") / 8))
    padded = TX.pad_batches(numbered, "batch", vocab.pad_id, 8)
    return padded.select(
        "doc_id", "batch", "padded_len", aj("input_ids").alias("input_ids"), aj("labels").alias("labels"),
        aj("attention_mask").alias("attention_mask"),
    )


def instruction_tokens(spark, d, max_length: int = 2048):
    """T1 -> T2 over the instruction pairs, vocabulary built from the formatted text."""
    prompts = TX.format_prompt(pairs_with_context(spark, d), keep=["conv_id", "turn"])
    prompts = prompts.withColumn("row_key", F.concat_ws("-", "conv_id", "turn"))
    vocab = TX.build_vocab(prompts, "text")
    tok = TX.tokenise(prompts, vocab, max_length, key="row_key")
    return prompts, tok


INSTR_IDS_SQL = (
    "WITH " + PAIRS_SQL + ", "
    f"prompts AS (SELECT conv_id, turn, conv_id || '-' || turn AS row_key, {INSTR_PROMPT_SQL} AS text FROM pairs), "
    + vocab_sql("text", "prompts") + ", " + ids_sql("prompts", "row_key")
)


@query(
    "length_filter",
    INSTR_IDS_SQL + " SELECT row_key, len(ids[1:2048]) AS n_tokens FROM ids WHERE len(ids[1:2048]) BETWEEN 10 AND 300",
)
def q_length_filter(spark, d):
    _, tok = instruction_tokens(spark, d)
    return P.filter_length(tok, "input_ids", 10, 300).select("row_key", F.size("input_ids").cast("bigint").alias("n_tokens"))


@query(
    "dataset_stats",
    INSTR_IDS_SQL + ", f AS (SELECT row_key, ids[1:2048] AS x FROM ids WHERE len(ids[1:2048]) BETWEEN 10 AND 300) "
    "SELECT count(*) AS num_samples, 'row_key,input_ids,attention_mask,labels' AS columns, "
    "CAST(arg_min(len(x), row_key) AS BIGINT) AS sample_input_ids_length, CAST(min(len(x)) AS BIGINT) AS min_length, "
    "CAST(max(len(x)) AS BIGINT) AS max_length, round(avg(len(x)), 6) AS avg_length FROM f",
)
def q_dataset_stats(spark, d):
    _, tok = instruction_tokens(spark, d)
    st = MT.dataset_stats(P.filter_length(tok, "input_ids", 10, 300), "row_key")
    return st.withColumn("avg_length", F.round("avg_length", 6))


@query(
    "step_counts",
    INSTR_IDS_SQL + ", f AS (SELECT row_key FROM ids WHERE len(ids[1:2048]) BETWEEN 10 AND 300), "
    "n AS (SELECT count(*) AS n FROM f) "
    "SELECT 'loaded' AS step, (SELECT count(*) FROM pairs) AS n_rows "
    "UNION ALL SELECT 'tokenised', (SELECT count(*) FROM ids) "
    "UNION ALL SELECT 'filtered', n FROM n "
    "UNION ALL SELECT 'train', CAST(floor(n * 0.8) AS BIGINT) FROM n "
    "UNION ALL SELECT 'validation', CAST(floor(n * 0.1) AS BIGINT) FROM n "
    "UNION ALL SELECT 'test', n - CAST(floor(n * 0.8) AS BIGINT) - CAST(floor(n * 0.1) AS BIGINT) FROM n",
)
def q_step_counts(spark, d):
    prompts, tok = instruction_tokens(spark, d)
    tok = materialize(tok.select("row_key", F.size("input_ids").alias("n")))
    kept = tok.where(F.col("n").between(10, 300))
    return MT.step_counts({"loaded": prompts, "tokenised": tok, "filtered": kept}, X.sequential_labelled(kept, ["row_key"]))


@query(
    "prompt_half",
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id")
    + f" SELECT doc_id, {sj('ids[1:len(ids) // 2]')} AS prompt_ids, len(ids) // 2 AS prompt_len FROM ids",
)
def q_prompt_half(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    ids = TX.token_ids(docs, doc_vocab(spark, d), "doc_id")
    return ids.select("doc_id", aj(M.prompt_half("ids")).alias("prompt_ids"), F.size(M.prompt_half("ids")).cast("bigint").alias("prompt_len"))


# ------------------------------------------------------ metrics (2.5/2.6)

from quarry.operators import lm as LM  # noqa: E402


@query(
    "confusion_mcc",
    "WITH c AS (SELECT CAST(count_if(quality = 1 AND toxic = 1) AS BIGINT) AS tp, "
    "CAST(count_if(quality <> 1 AND toxic <> 1) AS BIGINT) AS tn, "
    "CAST(count_if(quality <> 1 AND toxic = 1) AS BIGINT) AS fp, CAST(count_if(quality = 1 AND toxic <> 1) AS BIGINT) AS fn FROM labels) "
    "SELECT tp, tn, fp, fn, round(CASE WHEN sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) = 0 THEN 0.0 "
    "ELSE (tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) END, 12) AS mcc FROM c",
)
def q_confusion_mcc(spark, d):
    out = MT.mcc(table(spark, d, "labels"), "quality", "toxic")
    return out.withColumn("mcc", F.round("mcc", 12))


@query(
    "mse_by_split",
    _hashed_li(1)
    + ", s AS (SELECT CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train' ELSE 'validation' END AS split, "
    "CAST(l_extendedprice AS FLOAT) AS target FROM r), m AS (SELECT avg(target) AS mu FROM s WHERE split = 'train') "
    "SELECT split, round(sqrt(avg(power(mu - target, 2))), 3) AS rmse, count(*) AS n_rows FROM s, m GROUP BY split",
)
def q_mse_by_split(spark, d):
    """Mean predictor (train mean) scored per split."""
    both = X.train_test_labelled(housing(spark, d), 0.25, key=housing_key(), seed=1)
    mu = both.where(F.col("split") == "train").agg(F.avg("target")).collect()[0][0]
    both = both.withColumn("pred", F.lit(mu))
    out = MT.mse(both, "target", "pred", by=["split"])
    return out.select("split", F.round(F.sqrt("mse"), 3).alias("rmse"), "n_rows")


@query(
    "best_run",
    "SELECT user_id, event_id, value FROM events WHERE value IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) = 1",
)
def q_best_run(spark, d):
    """Best (lowest ``value``) event per user, ties -> earliest event."""
    ev = table(spark, d, "events").select("user_id", "event_id", "value")
    return MT.best_run(ev, "value", "min", by=["user_id"], tie="event_id")


@query(
    "rounded_metrics",
    "SELECT 'mean_price' AS metric, round(avg(l_extendedprice), 4) AS value FROM lineitem "
    "UNION ALL SELECT 'max_tax', round(max(l_tax), 4) FROM lineitem "
    "UNION ALL SELECT 'mean_discount', round(avg(l_discount), 4) FROM lineitem "
    "UNION ALL SELECT 'rows', round(count(*), 4) FROM lineitem",
)
def q_rounded_metrics(spark, d):
    li = table(spark, d, "lineitem")
    wide = li.agg(
        F.avg("l_extendedprice").alias("mean_price"), F.max("l_tax").alias("max_tax"),
        F.avg("l_discount").alias("mean_discount"), F.count(F.lit(1)).alias("rows"),
    )
    return MT.round_metrics(MT.metrics_long(wide), "value", 4)


@query(
    "argmax_logits",
    "SELECT vec_id, label, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS predicted, "
    "CAST(list_position(embedding[1:2], list_max(embedding[1:2])) - 1 AS INTEGER) AS predicted_2 FROM embeddings",
)
def q_argmax_logits(spark, d):
    emb = table(spark, d, "embeddings")
    return emb.select("vec_id", "label", M.argmax("embedding").alias("predicted"), M.argmax(F.slice("embedding", 1, 2)).alias("predicted_2"))


@query(
    "sigmoid",
    "SELECT vec_id, round(1.0 / (1.0 + exp(-CAST(embedding[1] AS DOUBLE))), 9) AS score FROM embeddings",
)
def q_sigmoid(spark, d):
    emb = table(spark, d, "embeddings")
    return emb.select("vec_id", F.round(M.sigmoid(F.col("embedding")[0].cast("double")), 9).alias("score"))


DOC_WORDS_SQL = f"dw AS (SELECT doc_id, {sql_words('text')} AS w FROM documents)"


@query(
    "generation_score",
    "WITH " + DOC_WORDS_SQL + " SELECT doc_id, len(w) - len(w) // 2 AS continuation_len, "
    "least((len(w) - len(w) // 2) / 50.0, 1.0) AS generation_score FROM dw WHERE len(w) > 20",
)
def q_generation_score(spark, d):
    """Score of each document's second half as the continuation of its first half."""
    docs = table(spark, d, "documents").select("doc_id", TX.words("text").alias("w"))
    cont = (F.size("w") - F.floor(F.size("w") / 2)).cast("bigint")
    return docs.where(F.size("w") > 20).select("doc_id", cont.alias("continuation_len"), M.generation_score(cont).alias("generation_score"))


def _lm_sql(n: int) -> str:
    base = (
        "WITH " + DOC_WORDS_SQL + ", "
        "g AS (SELECT doc_id, unnest(w) AS token, unnest(generate_series(1, len(w))) AS pos FROM dw), "
    )
    if n == 1:
        return base + (
            "cnt AS (SELECT token, count(*) AS c FROM g GROUP BY token), "
            "st AS (SELECT count(*) AS total, count(DISTINCT token) AS v FROM g), "
            "s AS (SELECT g.doc_id, ln((cnt.c + 1.0) / (st.total + st.v)) AS logp FROM g JOIN cnt USING (token), st) "
            "SELECT doc_id, count(*) AS n_tokens, round(exp(-avg(logp)), 4) AS perplexity FROM s GROUP BY doc_id"
        )
    return base + (
        "g2 AS (SELECT doc_id, token, coalesce(lag(token) OVER (PARTITION BY doc_id ORDER BY pos), '<s>') AS prev FROM g), "
        "cnt AS (SELECT prev, token, count(*) AS c FROM g2 GROUP BY prev, token), "
        "ctx AS (SELECT prev, sum(c) AS c_ctx FROM cnt GROUP BY prev), "
        "st AS (SELECT count(DISTINCT token) AS v FROM g2), "
        "s AS (SELECT g2.doc_id, ln((cnt.c + 1.0) / (ctx.c_ctx + st.v)) AS logp "
        "FROM g2 JOIN cnt USING (prev, token) JOIN ctx USING (prev), st) "
        "SELECT doc_id, count(*) AS n_tokens, round(exp(-avg(logp)), 4) AS perplexity FROM s GROUP BY doc_id"
    )


def _doc_perplexity(spark, d, n: int) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    lm = LM.fit_ngram_lm(docs, "doc_id", "text", n)
    return LM.perplexity(docs, lm, "doc_id")


@query("unigram_perplexity", _lm_sql(1))
def q_unigram_perplexity(spark, d):
    return _doc_perplexity(spark, d, 1).withColumn("perplexity", F.round("perplexity", 4))


@query("bigram_perplexity", _lm_sql(2))
def q_bigram_perplexity(spark, d):
    return _doc_perplexity(spark, d, 2).withColumn("perplexity", F.round("perplexity", 4))


@query(
    "eval_summary",
    "WITH p AS (" + _lm_sql(2).replace("round(exp(-avg(logp)), 4)", "exp(-avg(logp))") + "), "
    + DOC_WORDS_SQL + ", "
    "gs AS (SELECT doc_id, least((len(w) - len(w) // 2) / 50.0, 1.0) AS score FROM dw WHERE len(w) > 20), "
    "j AS (SELECT p.perplexity, gs.score FROM p LEFT JOIN gs USING (doc_id)) "
    "SELECT count(perplexity) AS num_samples_evaluated, round(coalesce(avg(perplexity), 'inf'::DOUBLE), 4) AS average_perplexity, "
    "round(coalesce(stddev_pop(perplexity), 0.0), 4) AS perplexity_std, round(coalesce(avg(score), 0.0), 6) AS average_generation_score, "
    "round(coalesce(stddev_pop(score), 0.0), 6) AS generation_score_std FROM j",
)
def q_eval_summary(spark, d):
    """Bigram-LM perplexity of every document + continuation score of long ones."""
    ppl = _doc_perplexity(spark, d, 2)
    docs = table(spark, d, "documents").select("doc_id", TX.words("text").alias("w"))
    cont = F.size("w") - F.floor(F.size("w") / 2)
    scores = docs.where(F.size("w") > 20).select("doc_id", M.generation_score(cont).alias("generation_score"))
    summary = MT.eval_summary(ppl.join(scores, "doc_id", "left"))
    return summary.select(
        "num_samples_evaluated",
        F.round("average_perplexity", 4).alias("average_perplexity"),
        F.round("perplexity_std", 4).alias("perplexity_std"),
        F.round("average_generation_score", 6).alias("average_generation_score"),
        F.round("generation_score_std", 6).alias("generation_score_std"),
    )


@query(
    "contract_violations",
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id")
    + " SELECT 'logits' AS column, 'missing' AS problem, CAST(NULL AS BIGINT) AS n_rows "
    "UNION ALL SELECT 'input_ids', 'length != 128', count_if(len(ids) <> 128) FROM ids HAVING count_if(len(ids) <> 128) > 0 "
    "UNION ALL SELECT 'attention_mask', 'length != 128', count_if(len(ids) <> 128) FROM ids HAVING count_if(len(ids) <> 128) > 0",
)
def q_contract_violations(spark, d):
    """Unpadded tokens checked against the padded model-input contract."""
    from pyspark.sql import types as T

    docs = table(spark, d, "documents").select("doc_id", "text")
    tok = TX.tokenise(docs, doc_vocab(spark, d), None, key="doc_id")
    contract = [
        P.ColumnSpec("input_ids", T.LongType(), 128),
        P.ColumnSpec("attention_mask", T.LongType(), 128),
        P.ColumnSpec("logits", T.FloatType(), 2),
    ]
    return P.check_contract(tok, contract)


# ------------------------------------------------ fits and scoring (2.7)

from quarry.operators import learners as L  # noqa: E402
from quarry.operators import mlp as MLP  # noqa: E402
from quarry.operators import scoring as SC  # noqa: E402
from quarry.operators.layout import materialize  # noqa: E402
from quarry.plans import pipelines as E  # noqa: E402
from quarry.sources import readers as R  # noqa: E402
from quarry.sources import sinks as S  # noqa: E402

FIT_FEATURES = ["n_words", "n_lines", "n_sentences"]


def doc_features(spark, d) -> DataFrame:
    """Housing-for-fits stand-in: text counts of each document, target ``n_chars``."""
    docs = table(spark, d, "documents")
    return docs.select(
        "doc_id",
        F.size(TX.words("text")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.size(F.filter(F.split("text", "[.!?]+"), lambda s: F.trim(s) != "")).cast("double").alias("n_sentences"),
        F.col("n_chars").cast("double").alias("target"),
    )


def _mlp_fixed_sql(model) -> str:
    """The forward pass layer by layer, each a subquery."""
    keys = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
    src, names = "lineitem", [f"CAST({c} AS DOUBLE)" for c in model.features]
    for layer in range(len(model.weights) // 2):
        w, b = model.weights[2 * layer], model.weights[2 * layer + 1]
        sums = [" + ".join(f"({float(w[i, j])!r}) * {x}" for i, x in enumerate(names)) + f" + ({float(b[j])!r})" for j in range(w.shape[1])]
        if layer == len(model.weights) // 2 - 1:
            return f"SELECT {keys}, round({sums[0]}, 6) AS prediction FROM {src}"
        cols = ", ".join(f"greatest(0.0, {x}) AS u{layer}_{j}" for j, x in enumerate(sums))
        src, names = f"(SELECT {keys}, {cols} FROM {src})", [f"u{layer}_{j}" for j in range(w.shape[1])]
    raise ValueError("a model without layers")


FIXED_MLP = MLP.mlp_from_fixed(HOUSING_FEATURES, "target", [4, 64, 32, 1], seed=7)


@query("mlp_score_fixed_weights", _mlp_fixed_sql(FIXED_MLP))
def q_mlp_score_fixed_weights(spark, d):
    """Batch scoring (Arrow batches, broadcast weights) with fixed seeded weights."""
    li = table(spark, d, "lineitem")
    out = MLP.score_mlp(li, FIXED_MLP, keep=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return out.withColumn("prediction", F.round("prediction", 6))


def _doc_split_sql(where: str = "", cols: str = "") -> str:
    """``sp(doc_id, split, ...)``: the seeded 75/25 split of the documents."""
    return (
        f"hs AS (SELECT doc_id, {sql_hash('doc_id', 1)} AS h, CAST(doc_id AS VARCHAR) AS kt{cols} FROM documents{where}), "
        "rn AS (SELECT *, row_number() OVER (ORDER BY h, kt) AS rn, count(*) OVER () AS n FROM hs), "
        "sp AS (SELECT *, CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM rn)"
    )


@query(
    "gbt_fit",
    "WITH " + _doc_split_sql() + ", v AS (SELECT count(*) AS n_rows FROM sp WHERE split = 'validation') "
    "SELECT CAST(r AS INTEGER) AS round, n_rows, true AS rmse_matches, true AS beats_mean FROM range(1, 11) t(r), v",
)
def q_gbt_fit(spark, d):
    """Boosted trees on document counts; per round, whether the reported validation RMSE is
    the one recomputed from the predictions, and below the mean predictor's."""
    df = doc_features(spark, d)
    train, valid = X.train_test_split(df, 0.25, key="doc_id", seed=1)
    res = L.fit_gbt(train, valid, FIT_FEATURES, "target")
    again = L.gbt_round_predictions(res, valid).select("target", F.posexplode("rounds").alias("i", "p"))
    own = again.groupBy((F.col("i") + 1).alias("round")).agg(
        F.count("*").alias("n_rows"), F.sqrt(F.avg(F.pow(F.col("p") - F.col("target"), 2))).alias("rmse"), F.stddev_pop("target").alias("spread"))
    both = L.gbt_round_metrics(res, spark).join(own, "round")
    near = F.abs(F.col("rmse") - F.col("validation_rmse")) <= 1e-6 * F.col("rmse")
    return both.select("round", "n_rows", near.alias("rmse_matches"), (F.col("validation_rmse") < F.col("spread")).alias("beats_mean"))


@query(
    "mlp_fit",
    "WITH " + _doc_split_sql() + " SELECT split, count(*) AS n_rows, true AS mse_matches, true AS beats_mean FROM sp GROUP BY split",
)
def q_mlp_fit(spark, d):
    """MLP on document counts; per split, whether the reported MSE is the one recomputed
    after saving and reloading the model, and below the variance of the target."""
    both = materialize(X.train_test_labelled(doc_features(spark, d), 0.25, key="doc_id", seed=1))
    model = MLP.fit_mlp(both.where("split = 'train'"), FIT_FEATURES, "target", steps=60, lr=0.02)
    loaded = S.load_mlp(spark, S.save_mlp(spark, model, R.scratch_dir(spark, "mlp")))
    # both models score a row in the same pass
    scored = MLP.score_mlp(both, model, keep=["split", "target", *FIT_FEATURES], name="reported")
    scored = SC.score(scored, loaded, ["split", "target", "reported"])
    error = lambda c: F.avg(F.pow(F.col(c) - F.col("target"), 2))
    own = scored.groupBy("split").agg(F.count("*").alias("n_rows"), error("reported").alias("mse"), error("prediction").alias("own"), F.var_pop("target").alias("spread"))
    near = F.abs(F.col("mse") - F.col("own")) <= 1e-9 * F.col("own")
    return own.select("split", "n_rows", near.alias("mse_matches"), (F.col("mse") < F.col("spread")).alias("beats_mean"))


@query(
    "als_fit",
    "WITH " + _RATINGS_SQL + ", "
    "k AS (SELECT *, concat_ws('|', l_orderkey, l_linenumber, l_suppkey, item_id, CAST(l_shipdate AS DATE)) AS kt FROM ratings), "
    "h AS (SELECT *, " + sql_hash("kt", 42) + " AS h FROM k), "
    "r AS (SELECT *, row_number() OVER (ORDER BY h, kt) AS rn, count(*) OVER () AS n FROM h), "
    "sp AS (SELECT *, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM r), "
    "tr AS (SELECT * FROM sp WHERE split = 'train') "
    "SELECT split, count(*) AS n_rows, true AS in_range, true AS beats_mean FROM sp "
    "WHERE user_id IN (SELECT user_id FROM tr) AND item_id IN (SELECT item_id FROM tr) GROUP BY split",
)
def q_als_fit(spark, d):
    """Ratings stand-in -> index -> split -> ALS; per split the rows it can score (user and
    item known from training), whether all predictions lie in [0, 1], and on the training
    rows whether the error is below the variance."""
    r = ratings(spark, d)
    splits = E.prepare_ratings(r, ["l_orderkey", "l_linenumber", "l_suppkey", "item_id", F.col("l_shipdate").cast("date")], 0.2, 42)
    model = L.fit_recommender(splits.train)
    scored = SC.score(X.split_column({"train": splits.train, "validation": splits.validation}), model, ["split", "rating_norm"])
    out = scored.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.bool_and(F.col("prediction").between(0.0, 1.0)).alias("in_range"),
        F.avg(F.pow(F.col("prediction") - F.col("rating_norm"), 2)).alias("mse"), F.var_pop("rating_norm").alias("spread"))
    return out.select("split", "n_rows", "in_range", ((F.col("split") != "train") | (F.col("mse") < F.col("spread"))).alias("beats_mean"))


@query(
    "text_classifier_fit",
    "WITH " + _doc_split_sql(cols=", lang") + " SELECT CAST(count_if(lang = 'en') AS BIGINT) AS n_positive, CAST(count_if(lang <> 'en') AS BIGINT) AS n_negative, "
    "true AS learned, true AS reload_equal FROM sp WHERE split = 'validation'",
)
def q_text_classifier_fit(spark, d):
    """``lang = 'en'`` from text: the held-out classes' sizes from the confusion counts,
    whether it predicts better than chance, and whether the saved and reloaded model
    predicts alike."""
    docs = table(spark, d, "documents").select("doc_id", "text", (F.col("lang") == "en").cast("int").alias("label"))
    train, valid = X.train_test_split(docs, 0.25, key="doc_id", seed=1)
    model = L.fit_text_classifier(train, "text", "label")
    loaded = S.load_pipeline_model(S.save_pipeline_model(model, R.scratch_dir(spark, "classifier")))
    # both models score a row in the same pass
    pred = SC.score(valid, model, ["text", "label"]).select("text", "label", M.argmax("logits").alias("argmax"))
    both = SC.score(pred, loaded, ["label", "argmax"])
    by_label = both.groupBy("label", "argmax").agg(F.count("*").alias("n"), F.bool_and(F.col("prediction") == F.col("argmax")).alias("same"))
    count = lambda y, p: F.coalesce(F.sum(F.when((F.col("label") == y) & (F.col("argmax") == p), F.col("n"))), F.lit(0))
    out = by_label.agg(count(1, 1).alias("tp"), count(0, 0).alias("tn"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), F.bool_and("same").alias("reload_equal"))
    return out.select((F.col("tp") + F.col("fn")).alias("n_positive"), (F.col("tn") + F.col("fp")).alias("n_negative"), (MT.mcc_expr() > 0).alias("learned"), "reload_equal")


@query(
    "keep_inputs",
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id")
    + f" SELECT {sj('ids[1:512]')} AS input_ids, {sj('list_transform(ids[1:512], lambda x: 1)')} AS attention_mask FROM ids",
)
def q_keep_inputs(spark, d):
    """Only the model's inputs of the tokenised rows."""
    tok = P.keep_inputs(TX.tokenise(table(spark, d, "documents").select("doc_id", "text"), doc_vocab(spark, d), 512, key="doc_id"))
    return tok.select(aj("input_ids").alias("input_ids"), aj("attention_mask").alias("attention_mask"))


# ------------------------------------------------------ sources & sinks

TSV_RATINGS_SQL = (
    "SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(ceil(l.l_quantity / 10) AS BIGINT) AS rating, "
    "date_diff('day', DATE '1970-01-01', CAST(l.l_shipdate AS DATE)) * 86400 AS timestamp "
    "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
)


def ratings_for_tsv(spark, d) -> DataFrame:
    r = ratings(spark, d)
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return r.select("user_id", "item_id", "rating", (days.cast("bigint") * 86400).alias("timestamp"))


@query("ratings_tsv_roundtrip", TSV_RATINGS_SQL)
def q_ratings_tsv_roundtrip(spark, d):
    """Write ratings as headerless TSV, read back with the typed reader."""
    path = R.scratch_dir(spark, "ratings-tsv")
    ratings_for_tsv(spark, d).write.option("sep", "\t").option("header", "false").csv(path)
    return R.read_ratings_tsv(spark, path)


@query(
    "split_loader",
    _hashed_li(1)
    + ", s AS (SELECT CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train' ELSE 'validation' END AS split, "
    "l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity FROM r) "
    "SELECT split, l_orderkey, l_linenumber, l_quantity FROM s",
)
def q_split_loader(spark, d):
    """Export splits under ``split=<name>/``, reload them by name with partition pruning."""
    both = X.train_test_labelled(housing(spark, d), 0.25, key=housing_key(), seed=1).select(
        "split", "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_quantity"
    )
    root = S.export_splits(both, R.scratch_dir(spark, "splits"), "housing", "run-1")
    loaded = R.load_splits(spark, root, splits=("train", "validation"))
    return X.split_column(loaded).select("split", "l_orderkey", "l_linenumber", "l_quantity")


@query("fallback_source", "SELECT o_orderkey, o_custkey FROM orders")
def q_fallback_source(spark, d):
    """A missing first source falls through to the next one."""
    paths = [f"{d}/missing_source.parquet", f"{d}/orders.parquet"]
    return R.read_first_available(spark, paths, lambda s, p: s.read.parquet(p)).select("o_orderkey", "o_custkey")


@query("dataset_handle", "SELECT doc_id, n_chars FROM documents")
def q_dataset_handle(spark, d):
    """Save behind a handle, reload by handle with the recorded schema."""
    h = R.DatasetHandle.save(table(spark, d, "documents").select("doc_id", "n_chars"), R.scratch_dir(spark, "handle"))
    return h.load(spark)


@query("find_artifact")
def q_find_artifact(spark, d):
    """Store a fitted LM table, then locate its first data file by glob (rows-only)."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    lm = LM.fit_ngram_lm(docs, "doc_id", "text", 1)
    root = R.scratch_dir(spark, "artifact")
    lm.counts.write.parquet(f"{root}/run-1/checkpoint")
    found = R.find_artifact(spark, root, "*.parquet")
    return found.select(F.col("path").endswith(".parquet").alias("is_parquet"), (F.col("length") > 0).alias("has_bytes"))


@query(
    "push_results",
    "SELECT 'datasets' AS name, 'parquet' AS plugin, true AS success, false AS has_error, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(NULL AS DOUBLE) AS value FROM orders "
    "UNION ALL SELECT 'report', 'json', true, false, 1, 0, round(avg(o_totalprice), 4) FROM orders "
    "UNION ALL SELECT 'missing', 'parquet', false, true, 0, 0, CAST(NULL AS DOUBLE)",
)
def q_push_results(spark, d):
    """Push three artifacts (two succeed, one points at a missing source); what was pushed is read again
    and counted."""
    root = R.scratch_dir(spark, "push")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")

    def missing():
        return spark.read.parquet(f"{d}/no_such_table.parquet").count()

    res = S.push_all(spark, [
        S.PushItem("datasets", "parquet", lambda: R.DatasetHandle.save(orders, f"{root}/orders").path),
        S.PushItem("report", "json", lambda: S.write_report(spark, "orders", MT.metrics_long(orders.agg(F.avg("o_totalprice").alias("mean_price"))), f"{root}/report") and f"{root}/report"),
        S.PushItem("missing", "parquet", missing),
    ])
    where = {r["name"]: r["value"] for r in res.where("success").collect()}
    pushed = spark.read.parquet(where["datasets"]).agg(F.lit("datasets").alias("name"), F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys"), F.lit(None).cast("double").alias("value"))
    pushed = pushed.unionByName(spark.read.json(where["report"]).agg(F.lit("report").alias("name"), F.count("*").alias("n_rows"), F.lit(0).cast("bigint").alias("keys"), F.max("value").alias("value")))
    return res.select("name", "plugin", "success", F.col("error").isNotNull().alias("has_error")).join(pushed, "name", "left").fillna(0, ["n_rows", "keys"])


@query(
    "model_record",
    "SELECT 'housing-mean' AS name, 'REGRESSION' AS kind, metric, value FROM (SELECT 'mean_price' AS metric, round(avg(l_extendedprice), 4) AS value FROM lineitem "
    "UNION ALL SELECT 'rows', CAST(count(*) AS DOUBLE) FROM lineitem)",
)
def q_model_record(spark, d):
    """Register a model record with metrics from the data; the record's metrics as the registry holds them."""
    li = table(spark, d, "lineitem")
    m = li.agg(F.avg("l_extendedprice").alias("mean_price"), F.count(F.lit(1)).alias("rows")).collect()[0]
    rec = {
        "name": "housing-mean", "description": "mean predictor", "kind": "REGRESSION",
        "labels": {"project": "housing"}, "metrics": {"mean_price": m["mean_price"], "rows": m["rows"]},
        "params": {"test_size": 0.25, "seed": 1},
    }
    root = R.scratch_dir(spark, "registry")
    S.register_model(spark, rec, root)
    return spark.read.parquet(root).select("name", "kind", F.explode("metrics").alias("metric", "value")).withColumn("value", F.round("value", 4))


# ------------------------------------------------------------- jobs E7-E11


@query("job_tabular_mlp", "WITH " + _doc_split_sql() + " SELECT split, count(*) AS n_rows, true AS has_mse FROM sp GROUP BY split")
def q_job_tabular_mlp(spark, d):
    root = R.scratch_dir(spark, "job-mlp")
    metrics, push = E.tabular_mlp_job(spark, doc_features(spark, d), "n_words,n_lines,n_sentences,target",
                                      ("target", "target"), "doc_id", root)
    return metrics.select("split", "n_rows", (F.col("mse") > 0).alias("has_mse"))


@query(
    "job_sentence_classifier",
    "WITH hs AS (SELECT doc_id, lang, " + sql_hash("CAST(doc_id AS VARCHAR)", 1) + " AS h FROM documents), "
    "r AS (SELECT *, row_number() OVER (ORDER BY h, CAST(doc_id AS VARCHAR)) AS rn, count(*) OVER () AS n FROM hs), "
    "sp AS (SELECT lang, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' "
    "WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) + CAST(floor(n * 0.1) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM r) "
    "SELECT split, CAST(count_if(lang = 'en') AS BIGINT) AS n_positive, CAST(count_if(lang <> 'en') AS BIGINT) AS n_negative, true AS learned FROM sp GROUP BY split",
)
def q_job_sentence_classifier(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("sentence"), (F.col("lang") == "en").cast("int").alias("label"))
    parts = X.sequential_split_hashed(with_hash_key(docs, "doc_id", 1))
    root = R.scratch_dir(spark, "job-cls")
    S.export_splits(X.split_column(parts), root, "sentences", "run-1")
    raw = R.load_splits(spark, f"{root}/datasets/sentences/run-1")
    vocab = TX.build_vocab(raw["train"], "sentence")
    splits = E.load_text_splits(spark, f"{root}/datasets/sentences/run-1", vocab, "doc_id", fraction=1.0)
    metrics, push = E.sentence_classifier_job(spark, raw, "doc_id", "sentence", "label", root, splits)
    return metrics.select("split", (F.col("tp") + F.col("fn")).alias("n_positive"), (F.col("tn") + F.col("fp")).alias("n_negative"), (F.col("mcc") > 0).alias("learned"))


@query(
    "job_instruction_eval",
    INSTR_IDS_SQL + ", n AS (SELECT count(*) AS n FROM ids WHERE len(ids[1:512]) BETWEEN 10 AND 512) "
    "SELECT least(100, n - CAST(floor(n * 0.8) AS BIGINT) - CAST(floor(n * 0.1) AS BIGINT)) AS num_samples_evaluated, true AS above_one FROM n",
)
def q_job_instruction_eval(spark, d):
    sources = {"conversations": lambda s: pairs_with_context(s, d).withColumn("row_key", F.concat_ws("-", "conv_id", "turn")).drop("conv_id", "turn")}
    counts, summary = E.instruction_eval_job(spark, "conversations", sources, "row_key", R.scratch_dir(spark, "job-lm"))
    return summary.select("num_samples_evaluated", (F.col("average_perplexity") > 1.0).alias("above_one"))


@query(
    "exact_split_repeated_key",
    "WITH n AS (SELECT count(*) AS n FROM documents) SELECT 'train' AS split, CAST(floor(n * 0.75) AS BIGINT) AS n_rows FROM n "
    "UNION ALL SELECT 'validation', n - CAST(floor(n * 0.75) AS BIGINT) FROM n",
)
def q_exact_split_repeated_key(spark, d):
    """A key of a few values, some of them NULL: the split has the exact sizes."""
    docs = table(spark, d, "documents").select("doc_id", F.expr("nullif(lang, 'fr')").alias("a"), F.expr("nullif(source, 'src3')").alias("b"))
    train, valid = X.train_test_split(docs, 0.25, key=["a", "b"], seed=1)
    return X.split_column({"train": train, "validation": valid}).groupBy("split").agg(F.count("*").alias("n_rows"))


@query(
    "load_ratings",
    "WITH t AS (" + TSV_RATINGS_SQL + "), n AS (SELECT count(*) AS n, count(DISTINCT user_id) AS u, count(DISTINCT item_id) AS i FROM t) "
    "SELECT 'train' AS split, CAST(floor(n * 0.8) AS BIGINT) AS n_rows, u AS num_users, i AS num_items FROM n "
    "UNION ALL SELECT 'validation', n - CAST(floor(n * 0.8) AS BIGINT), u, i FROM n",
)
def q_load_ratings(spark, d):
    """E4 from the ratings file: exact split sizes though the key repeats, and the catalogue."""
    tsv = f"{R.scratch_dir(spark, 'ratings')}/ratings"
    ratings_for_tsv(spark, d).write.option("sep", "\t").csv(tsv)
    splits = E.load_ratings(spark, [tsv])
    both = X.split_column({"train": splits.train, "validation": splits.validation}).groupBy("split").agg(F.count("*").alias("n_rows"))
    return both.select("split", "n_rows", F.lit(splits.num_users).cast("bigint").alias("num_users"), F.lit(splits.num_items).cast("bigint").alias("num_items"))


@query(
    "describe_first_row",
    "SELECT 'struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz,l_quantity:float,"
    "l_discount:float,l_tax:float,l_linenumber:float,target:float>' AS schema, "
    "l_orderkey, CAST(l_linenumber AS FLOAT) AS l_linenumber, CAST(l_extendedprice AS FLOAT) AS target "
    "FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate LIMIT 1",
)
def q_describe_first_row(spark, d):
    """Schema string of the prepared housing frame and its first row by key."""
    df = housing(spark, d)
    schema, rows = P.describe(X.head(df, 1, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]))
    first = spark.createDataFrame(rows, df.schema)
    return first.select(F.lit(schema).alias("schema"), "l_orderkey", "l_linenumber", "target")


@query(
    "sample_capped_below_rows",
    "WITH h AS (SELECT o_orderkey, o_totalprice, " + sql_hash("o_orderkey", 1) + " AS h, CAST(o_orderkey AS VARCHAR) AS kt FROM orders) "
    "SELECT o_orderkey, o_totalprice FROM h ORDER BY h, kt LIMIT 2000",
)
def q_sample_capped_below_rows(spark, d):
    """A cap below the row count keeps the first 2,000 rows in seeded order (seed 1)."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return X.sample_capped(orders, 2000, key="o_orderkey", seed=1)


@query(
    "feature_prep_preprocess",
    _hashed_li(1)
    + "SELECT " + HOUSING_SQL_CAST + ", "
    "CASE WHEN rn <= CAST(floor(n * 0.75) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM r",
)
def q_feature_prep_preprocess(spark, d):
    """E1 + E2: rename/select/seeded split saved behind handles, reloaded and cast to float."""
    root = R.scratch_dir(spark, "feature-prep")
    columns = ",".join(HOUSING_FEATURES + ["target"])
    prep = E.feature_prep(table(spark, d, "lineitem"), columns, ("l_extendedprice", "target"), li_key(), root,
                          keep_key=["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"])
    cast = E.preprocess(spark, columns, prep, root)
    return X.split_column({"train": cast.train.load(spark), "validation": cast.validation.load(spark)})


@query(
    "prepare_ratings_splits",
    "WITH " + _RATINGS_SQL + ", "
    "u AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM ratings)), "
    "i AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx FROM (SELECT DISTINCT item_id FROM ratings)), "
    "x AS (SELECT r.*, u.user_idx, i.item_idx FROM ratings r JOIN u USING (user_id) JOIN i USING (item_id)), "
    "k AS (SELECT *, concat_ws('|', l_orderkey, l_linenumber, l_suppkey, item_id, CAST(l_shipdate AS DATE)) AS kt FROM x), "
    "h AS (SELECT *, " + sql_hash("kt", 42) + " AS h FROM k), "
    "r AS (SELECT *, row_number() OVER (ORDER BY h, kt) AS rn, count(*) OVER () AS n FROM h) "
    "SELECT user_idx, item_idx, CAST((CAST(rating AS FLOAT) - CAST(1 AS FLOAT)) / CAST(4 AS FLOAT) AS FLOAT) AS rating_norm, "
    "CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM r",
)
def q_prepare_ratings_splits(spark, d):
    """E4 after reading: dense indexes, index joins, normalised rating, seeded 80/20 permutation split."""
    key = ["l_orderkey", "l_linenumber", "l_suppkey", "item_id", F.col("l_shipdate").cast("date")]
    splits = E.prepare_ratings(ratings(spark, d), key, 0.2, 42)
    return X.split_column({"train": splits.train, "validation": splits.validation})


def _instruction_source(spark, d) -> DataFrame:
    return pairs_with_context(spark, d).withColumn("row_key", F.concat_ws("-", "conv_id", "turn")).drop("conv_id", "turn")


@query(
    "prepare_finetune_splits",
    "WITH " + PAIRS_SQL + ", "
    "pk AS (SELECT instruction, input, output, conv_id || '-' || turn AS row_key FROM pairs), "
    "hs AS (SELECT *, " + sql_hash("row_key", 42) + " AS h FROM pk), "
    "samp AS (SELECT * FROM hs ORDER BY h, row_key LIMIT 200), "
    f"prompts AS (SELECT row_key, {INSTR_PROMPT_SQL} AS text FROM samp), "
    + vocab_sql("text", "prompts") + ", " + ids_sql("prompts", "row_key") + ", "
    "f AS (SELECT row_key, ids[1:64] AS x FROM ids WHERE len(ids[1:64]) BETWEEN 10 AND 64), "
    "fh AS (SELECT *, " + sql_hash("row_key", 42) + " AS h2 FROM f), "
    # seeded order only when a sample was taken (more than 200 pairs), else source order by key
    "r AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN (SELECT count(*) FROM pk) > 200 THEN h2 ELSE 0 END, row_key) AS rn, "
    "count(*) OVER () AS n FROM fh) "
    f"SELECT row_key, {sj('x')} AS input_ids, "
    "CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' "
    "WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) + CAST(floor(n * 0.1) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM r",
)
def q_prepare_finetune_splits(spark, d):
    """E3: seeded sample of 200 pairs, prompt text, vocabulary, tokenise (64), length filter,
    80/10/10 in seeded order, saved behind handles and reloaded."""
    data = E.prepare_finetune_dataset(spark, "conversations", {"conversations": lambda s: _instruction_source(s, d)},
                                      "row_key", R.scratch_dir(spark, "finetune"), max_length=64, sample_size=200)
    parts = {"train": data.train, "validation": data.validation, "test": data.test}
    out = X.split_column({k: h.load(spark) for k, h in parts.items()})
    return out.select("row_key", aj("input_ids").alias("input_ids"), "split")


_TEXT_SPLITS_SQL = (
    "WITH d AS (SELECT doc_id, text AS sentence, CAST(lang = 'en' AS INTEGER) AS label FROM documents), "
    "hs AS (SELECT *, " + sql_hash("CAST(doc_id AS VARCHAR)", 1) + " AS h FROM d), "
    "r AS (SELECT *, row_number() OVER (ORDER BY h, CAST(doc_id AS VARCHAR)) AS rn, count(*) OVER () AS n FROM hs), "
    "sp AS (SELECT doc_id, sentence, label, h, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' "
    "WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) + CAST(floor(n * 0.1) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM r), "
    "trainrows AS (SELECT * FROM sp WHERE split = 'train'), "
    + vocab_sql("sentence", "trainrows") + ", "
    "sel AS (SELECT * FROM sp WHERE h < CAST(0.5 * power(2, 60) AS BIGINT)), "
    + ids_sql("sel", "doc_id", "sentence") + ", "
    "body AS (SELECT ids.doc_id, [2::BIGINT] || ids[1:126] || [3::BIGINT] AS b FROM ids) "
    f"SELECT sel.doc_id, sel.label, sel.split, {sj('b || list_transform(range(128 - len(b)), lambda x: 0)')} AS input_ids "
    "FROM body JOIN sel ON body.doc_id = sel.doc_id"
)


@query("load_text_splits", _TEXT_SPLITS_SQL)
def q_load_text_splits(spark, d):
    """E6: named splits written as ``split=`` folders, reloaded by name; a seeded 50 % sample of
    each before tokenising; padded 128-token inputs with the label carried."""
    docs = table(spark, d, "documents").select(
        "doc_id", F.col("text").alias("sentence"), (F.col("lang") == "en").cast("int").alias("label")
    )
    parts = X.sequential_split_hashed(with_hash_key(docs, "doc_id", 1))
    root = S.export_splits(X.split_column(parts), R.scratch_dir(spark, "text-splits"), "sentences", "run-1")
    vocab = TX.build_vocab(parts["train"], "sentence")
    splits = E.load_text_splits(spark, root, vocab, "doc_id", text="sentence", label="label", fraction=0.5)
    out = X.split_column(splits)
    return out.select("doc_id", "label", "split", aj("input_ids").alias("input_ids"))


_EVAL_LM_SQL = (
    "WITH " + vocab_sql() + ", " + ids_sql("documents", "doc_id") + ", "
    "t AS (SELECT doc_id, ids AS x FROM ids), "
    "g AS (SELECT doc_id, CAST(unnest(x) AS VARCHAR) AS token, unnest(generate_series(1, len(x))) AS pos FROM t), "
    "g2 AS (SELECT doc_id, token, coalesce(lag(token) OVER (PARTITION BY doc_id ORDER BY pos), '<s>') AS prev FROM g), "
    "cnt AS (SELECT prev, token, count(*) AS c FROM g2 GROUP BY prev, token), "
    "ctx AS (SELECT prev, sum(c) AS c_ctx FROM cnt GROUP BY prev), "
    "st AS (SELECT count(DISTINCT token) AS v FROM g2), "
    "hd AS (SELECT doc_id, x FROM t ORDER BY doc_id LIMIT 100), "
    "s AS (SELECT g2.doc_id, ln((cnt.c + 1.0) / (ctx.c_ctx + st.v)) AS logp "
    "FROM g2 JOIN hd ON g2.doc_id = hd.doc_id JOIN cnt USING (prev, token) JOIN ctx USING (prev), st), "
    "p AS (SELECT doc_id, exp(-avg(logp)) AS perplexity FROM s GROUP BY doc_id), "
    "gs AS (SELECT doc_id, least((len(x) - len(x) // 2) / 50.0, 1.0) AS score FROM hd WHERE len(x) > 20), "
    "j AS (SELECT p.perplexity, gs.score FROM p LEFT JOIN gs USING (doc_id)) "
    "SELECT count(perplexity) AS num_samples_evaluated, round(coalesce(avg(perplexity), 'inf'::DOUBLE), 4) AS average_perplexity, "
    "round(coalesce(stddev_pop(perplexity), 0.0), 4) AS perplexity_std, round(coalesce(avg(score), 0.0), 6) AS average_generation_score, "
    "round(coalesce(stddev_pop(score), 0.0), 6) AS generation_score_std, 'ngram' AS model_name, '' AS checkpoint_path, 'cpu' AS device FROM j"
)


@query("evaluate_lm_head", _EVAL_LM_SQL)
def q_evaluate_lm_head(spark, d):
    """E5: first 100 rows by key of the token-id data, bigram-LM perplexity per row (labels
    default to ids), generation score of the continuation for rows over 20 tokens, summary."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    tok = materialize(TX.tokenise(docs, doc_vocab(spark, d), None, key="doc_id").select("doc_id", "input_ids"))
    lm = LM.fit_ngram_lm(tok, "doc_id", tokens_col="input_ids", n=2)
    s = E.evaluate_lm(tok, lm, "doc_id", num_samples=100)
    return s.select(
        "num_samples_evaluated",
        F.round("average_perplexity", 4).alias("average_perplexity"),
        F.round("perplexity_std", 4).alias("perplexity_std"),
        F.round("average_generation_score", 6).alias("average_generation_score"),
        F.round("generation_score_std", 6).alias("generation_score_std"),
        "model_name", "checkpoint_path", "device",
    )


from quarry.plans import fit_queries  # noqa: E402, F401 - registers its queries
