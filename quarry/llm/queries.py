"""The registered queries of this folder, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann, fingerprints, hard_negatives, jaccard_join, language_id, lm_scoring, mixing, packing, piece_encoding, toxicity, url_filter, warc, whitening
from quarry.llm.common import read, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(remainder(F.col("doc_id"), 5) != 0))
    judged = language_id.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), RULES)


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(remainder(F.col("doc_id"), 5) != 0)
    judged = toxicity.judge(docs, toxicity.fit(docs, labels))
    return judged.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = warc.captures(read(spark, sf_dir, "pages"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "shard", "position")


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), k=3, num=90, den=100)


@query
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(read(spark, sf_dir, "documents"))


LABELS = ["quality", "toxic"]
TARGETS = {"quality1_toxic0": 0.85, "quality0_toxic0": 0.10, "quality1_toxic1": 0.03, "quality0_toxic1": 0.02}


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"), LABELS, TARGETS)
    return mixed.select("doc_id", "n_tokens", *[F.coalesce(F.col("posterior")[d], F.lit(0.0)).alias(f"p_{d}") for d in TARGETS], "rate")


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = lm_scoring.score(read(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whitened(read(spark, sf_dir, "embeddings"), components=4, scale=256)
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabelled)


ORACLES["op12_hard_negatives"] = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(CAST(c AS DOUBLE) * 256)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
near AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
   AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM near WHERE rank <= 5
"""


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op13_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.digests(read(spark, sf_dir, "documents"), pieces_path())
