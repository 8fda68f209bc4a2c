"""The registered training-data queries: every operator over its whole table, reduced to digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import alignment, audit, fingerprints, langid, mixing, neardup, packing, pii, quality, sharding, suffixes, topk, warc
from mercato.session import configure, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.kd_shards(_table(spark, sf_dir, "documents"), shards=16)
    return out.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    out = warc.read_archives(spark, path, with_payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status")


@_query
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


@_query
def op3_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


@_query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@_query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=4)


@_query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(_table(spark, sf_dir, "documents"))


@_query
def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


@_query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = audit.failure_cells(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return audit.audit_orders(cells, "ABCDE")


ORACLES["op13_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d
), f AS (
  SELECT w.part,
    len(words) < 100 AS fa,
    100 * len(list_distinct(words)) < 80 * len(words) AS fb,
    100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS fc,
    regexp_matches(text, '[#$%&*|]') AS fd,
    coalesce(least < doc_id, false) AS fe,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS bad
  FROM w
), cells AS (
  SELECT part, fa::INT + 2 * fb::INT + 4 * fc::INT + 8 * fd::INT + 16 * fe::INT AS mask, good, bad, count(*) AS n
  FROM f GROUP BY ALL
), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[:step - 1])::BIGINT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (coalesce(before, 0) + bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(before, 0) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(before, 0) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN good AND mask & bit <> 0 AND mask & coalesce(before, 0) = 0 THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN bad AND mask & bit <> 0 AND mask & coalesce(before, 0) = 0 THEN n ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


@_query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(_table(spark, sf_dir, "documents"))
