"""The queries of the training-data operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize
from . import conversation_repair
from .decontamination import contaminated
from .jaccard_join import linked
from .language_id import predicted_language
from .lm_scoring import stupid_backoff
from .mixing import curriculum, size_column
from .packing import packed
from .pii import personal_data
from .quality_classifier import predicted_quality
from .quality_rules import judged
from .substring_dedup import repeated_words
from .suffix_dedup import repeated_passages
from .whitening import whitened


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages that stand in another document too; repeats within one text are no sign of a copied document."""
    return repeated_passages(_documents(spark, folder), min_words=50).where("NOT within").drop("within")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_words(_documents(spark, folder), words=20, doublings=1).select("doc_id", "n_words", "n_removed", "kept_sha256")


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return linked(_documents(spark, folder))


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scores = stupid_backoff(_documents(spark, folder), order=3, backoff=0.4, min_count=2)
    return scores.select("doc_id", "n_words", *(F.round(c, 6).alias(c) for c in ("log_score", "mean_log_score")))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged(_documents(spark, folder), _labels(spark, folder).where("quality = 1"))


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return predicted_quality(_documents(spark, folder), _labels(spark, folder))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return predicted_language(_documents(spark, folder))


def mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder).select("doc_id", "source", size_column().alias("size"))
    position = F.round(F.get("copies", F.lit(0))["position"], 3).alias("position")
    return curriculum(rows).select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", position)


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contaminated(_documents(spark, folder), items).drop("text_key")


def pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(_documents(spark, folder))


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{folder}/embeddings.parquet"), components=16, scale=64, shift=1_000_000)


def conversation_repairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    reports = materialize(conversation_repair.verdicts(rows), "conversation-reports")
    texts = conversation_repair.digests(rows, reports)
    return reports.join(texts.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")


def packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = packed(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffix_dedup,
    "op2_quality_rules": quality_rules,
    "op3_quality_classifier": quality_classifier,
    "op4_substring_dedup": substring_dedup,
    "op5_decontamination": decontamination,
    "op6_mixing": mixing,
    "op7_language_id": language_id,
    "op8_lm_scoring": lm_scoring,
    "op9_pii": pii,
    "op10_jaccard_join": jaccard_join,
    "op11_embedding_whitening": embedding_whitening,
    "op12_conversation_repair": conversation_repairs,
    "op13_packing": packing,
}

LM_SCORING = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d
), g AS (
  SELECT r, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS b,
         CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS c,
         w[i - 1] AS before_1, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS before_2 FROM p
), c1 AS (SELECT a, count(*) AS n FROM g GROUP BY a
), c2 AS (SELECT b, count(*) AS n FROM g WHERE b IS NOT NULL GROUP BY b
), c3 AS (SELECT c, count(*) AS n FROM g WHERE c IS NOT NULL GROUP BY c
), s AS (
  SELECT g.r,
    CASE WHEN c3.n >= 2 THEN ln(c3.n) - ln(x2.n)
         WHEN c2.n >= 2 THEN CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END + ln(c2.n) - ln(x1.n)
         ELSE ln(0.4) * least(i - 1, 2) + ln(c1.n) - ln((SELECT count(*) FROM g)) END AS v
  FROM g JOIN c1 ON c1.a = g.a LEFT JOIN c2 ON c2.b = g.b LEFT JOIN c3 ON c3.c = g.c
    LEFT JOIN c1 x1 ON x1.a = g.before_1 LEFT JOIN c2 x2 ON x2.b = g.before_2
), t AS (SELECT r, sum(v) AS v FROM s GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(v, 0), 6) AS log_score, round(v / len(w), 6) AS mean_log_score
FROM d LEFT JOIN t USING (r)
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM d GROUP BY source
), w AS (
  SELECT *, CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - 3 * coalesce(CAST(sum(source_size) OVER b AS BIGINT), 0))
           / (CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER b AS BIGINT), 0)) AS level,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS r
  FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), x AS (
  SELECT arg_min(level, r) AS level FROM l WHERE level * weight <= 3 * source_size
), t AS (
  SELECT l.source, l.turn, l.source_size, least(x.level * l.weight, CAST(3 * l.source_size AS DOUBLE)) AS target FROM l, x
), o AS (
  SELECT doc_id, size, t.source_size, t.target, t.turn,
    coalesce(CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - a)) + greatest(0, least(size, CAST(floor(target) AS BIGINT) - a - source_size))
    + greatest(0, least(size, CAST(floor(target) AS BIGINT) - a - 2 * source_size)) AS taken, a / target AS y FROM o
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  round(CASE WHEN taken > 0 THEN (SELECT sum(size) FROM d) * CASE turn
    WHEN 0 THEN 2 * y / (1.5 + sqrt(greatest(2.25 - 2 * y, 0))) WHEN 1 THEN 2 * y / (1 + sqrt(greatest(1 + 0 * y, 0)))
    ELSE 2 * y / (0.5 + sqrt(greatest(0.25 + 2 * y, 0))) END END, 3) AS position
FROM c
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w, text FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL
), ds AS (
  SELECT DISTINCT doc_id, text, s FROM (
    SELECT doc_id, text, w[k:k + 4] AS s FROM (SELECT *, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, text, w FROM d WHERE len(w) BETWEEN 1 AND 4)
), s AS (
  SELECT DISTINCT item_id, s FROM (
    SELECT item_id, w[k:k + 4] AS s FROM (SELECT *, unnest(range(1, len(w) - 3)) AS k FROM i WHERE len(w) >= 5)
    UNION ALL SELECT item_id, w FROM i WHERE len(w) BETWEEN 1 AND 4)
), n AS (SELECT item_id, count(*) AS n_item_shingles FROM s GROUP BY item_id
), c AS (SELECT doc_id, text, item_id, count(*) AS n_shared FROM ds JOIN s USING (s) GROUP BY doc_id, text, item_id)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles AS containment
FROM c JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item_shingles
"""

ORACLES: dict[str, str] = {
    "op5_decontamination": DECONTAMINATION,
    "op6_mixing": MIXING,
    "op8_lm_scoring": LM_SCORING,
}
