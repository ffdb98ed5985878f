"""One query per operator over the driver tables, and the SQL of those that
DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.llm import bpe, decontaminate, divergence, exact_dedup, hard_negatives, licenses, mixing, ngram_join, periodic_runs, sharding, surrogates, toxicity, warc
from snapstar.llm.common import WORD_BREAK, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"), words=3, num=9, den=10).drop("node")


#: Target shares of the labelled table's domains.
MIX = {"clean": 0.95, "poor": 0.05}


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.label_domains(table(spark, sf_dir, "labels")), MIX)
    return mixed.select("doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(sorted(MIX))], "rate")


#: The key of the registered query; a user gives their own.
SURROGATE_KEY = b"surrogates of the registered query"


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op4_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_folder(spark)
    return warc.read(warc.write(table(spark, sf_dir, "pages"), out, min_bytes=0), out)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """The documents that ``op11_periodic_runs`` reads: where the CRC-32 of the
    decimal doc_id is divisible by ten, the words from a place on repeat a period
    (both follow from the CRC)."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        shape = F.struct(n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))
        source = lambda i, s: F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"])
        return F.transform(F.array(shape), lambda s: F.array_join(
            F.transform(F.sequence(F.lit(0).cast("long"), s["n"] - 1), lambda i: F.element_at(w, (source(i, s) + 1).cast("int"))), " "))[0]

    words = F.array_remove(F.split(F.col("text"), WORD_BREAK), "")
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return docs.withColumn("text", F.when(crc % 10 == 0, planted).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(with_planted_tails(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r
), p AS (
  SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score, r AS pr FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.ar, pr ORDER BY s.score DESC, s.vec_id, s.r)
QUALIFY row_number() OVER w <= 3
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), i AS (
  SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0
), t AS (
  SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS win FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS s FROM i)
), x AS (
  SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT r, k, w, unnest(generate_series(1, len(w) - k + 1)) AS s FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)
), hit AS (
  SELECT r, s, k, item FROM x JOIN t USING (k, win)
), pos AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(s, s + k - 1)) AS p FROM (SELECT DISTINCT r, s, k FROM hit)) GROUP BY r
), its AS (
  SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_join, op2_mixing, op3_surrogates, op4_minimax_sharding, op5_exact_dedup, op6_toxicity, op7_divergence,
                                 op8_byte_bpe, op9_warc, op10_licenses, op11_periodic_runs, op12_hard_negatives, op13_decontamination)}


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5_SQL, "op12_hard_negatives": OP12_SQL, "op13_decontamination": OP13_SQL}
