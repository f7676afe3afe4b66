"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, common, licences, mixing, neardup, ogg, sentencepiece, substring, suffix, toxicity, warc


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(common.table(spark, sf_dir, "pages"), common.scratch(spark, "warc"))
    return warc.checked(warc.read_archives(manifest, with_payload=False)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.probe(ogg.store(common.table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op1_srs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(common.table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    return sentencepiece.digest(common.table(spark, sf_dir, "documents"), model_path)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(common.table(spark, sf_dir, "documents"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(common.table(spark, sf_dir, "documents"))


def op9_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(common.table(spark, sf_dir, "documents"), words=2).withColumnRenamed("id", "doc_id")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents")).select("doc_id", *mixing.NAMES)


SQL_OP6 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM d GROUP BY source),
w AS (SELECT *, list_extract([3, 1, 2], ((turn - 1) % 3 + 1)::INT) AS weight, CAST(source_size * 2 AS DOUBLE) AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER f, 0)) / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER f, 0)) AS step
  FROM w WINDOW f AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, (max(step) OVER ()) * weight) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, CAST(floor(p.target + 0.5) AS BIGINT) - p.whole * p.source_size AS rest,
  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('0:' || d.doc_id), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM r
"""

SQL_OP10 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
o AS (SELECT h, n, max(page_id) AS original FROM d GROUP BY h, n)
SELECT page_id, CAST(d.n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(d.h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM d JOIN o ON d.h = o.h AND d.n = o.n
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_srs": op1_srs, "op2_suffix": op2_suffix, "op3_toxicity": op3_toxicity, "op4_sentencepiece": op4_sentencepiece, "op5_licences": op5_licences, "op6_mix": op6_mix, "op7_substring": op7_substring, "op8_ogg": op8_ogg, "op9_setsketch": op9_setsketch, "op10_warc": op10_warc}
ORACLES: dict[str, str] = {"op6_mix": SQL_OP6, "op10_warc": SQL_OP10}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
