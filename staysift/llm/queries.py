"""Registered queries of the dealt operators: each runs over its whole table with
production parameters and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from staysift.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.bpe_codec import round_trip_digest

    return round_trip_digest(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    )


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)


@query
def op6_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: counts at most one apart (24 shards)."""
    from pyspark.sql import functions as F

    from staysift.llm.sharding import shuffle_into_shards

    data = F.col("text").cast("binary")
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text").cast("long"), F.lit(0)) + 8).alias("size"),
        F.crc32(F.coalesce(data, F.lit(b""))).alias("text_crc32"),
    )
    return shuffle_into_shards(narrow, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.common import held_out
    from staysift.llm.toxicity import score_toxicity

    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "score", "predicted")


@query
def op9_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.common import held_out
    from staysift.llm.quality_crf import score_quality

    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "score", "predicted")


@query
def op1_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.ann import search

    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query
def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.common import held_out
    from staysift.llm.language_id import identify_languages

    found = identify_languages(table(spark, sf_dir, "documents"))
    return found.withColumn("held_out", held_out("doc_id")).select(
        "doc_id", "held_out", "lang_pred", "score", "languages"
    )


@query
def op3_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


@query
def op11_line_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from staysift.llm.fill_in_middle import fill_in_middle, restored

    moved = fill_in_middle(table(spark, sf_dir, "documents"))
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op11_line_fill_in_middle"] = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM hashed
), placed AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS low,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS high
  FROM cut
), parts AS (
  SELECT *, coalesce(array_to_string(lines[1:low], ''), '') AS prefix,
         coalesce(array_to_string(lines[low + 1:high], ''), '') AS middle,
         coalesce(array_to_string(lines[high + 1:], ''), '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query
def op12_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.llm.importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: the whole texts of all ``benchmark`` items; answers: all ``documents``."""
    from pyspark.sql import functions as F

    from staysift.llm.bm25 import build_index, search

    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = search(build_index(table(spark, sf_dir, "documents")), items, k=10)
    return found.withColumn("score", F.round("score", 6))


ORACLES["op10_bm25_top_k"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (
  SELECT doc_id, len(regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS n
  FROM documents
), facts AS (SELECT count(*) AS docs, avg(n) AS mean_n FROM sizes),
asked AS (
  SELECT DISTINCT item_id AS query_id,
         unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), idf AS (
  SELECT term, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf
  FROM tf, facts GROUP BY term, docs
), scored AS (
  SELECT query_id, doc_id, sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean_n))) AS score
  FROM asked JOIN tf USING (term) JOIN idf USING (term) JOIN sizes USING (doc_id), facts
  GROUP BY query_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10
"""


@query
def bm25_document_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: the whole texts of the ``documents`` with an id divisible by 20; answers: all ``documents``."""
    from pyspark.sql import functions as F

    from staysift.llm.bm25 import build_index, search

    docs = table(spark, sf_dir, "documents")
    asked = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search(build_index(docs), asked, k=10).withColumn("score", F.round("score", 6))


ORACLES["bm25_document_queries"] = (
    ORACLES["op10_bm25_top_k"]
    .replace("SELECT DISTINCT item_id AS query_id", "SELECT DISTINCT doc_id AS query_id")
    .replace("FROM benchmark", "FROM documents WHERE doc_id % 20 = 0")
)
