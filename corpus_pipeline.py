"""From raw documents to a training order: quality, near duplicates, benchmarks, personal data, mixing.

Every stage takes (spark, docs, folder of tables) and returns a DataFrame, which is written and read again as the
next stage's docs.  All but the last return the columns of ``documents``.  Null texts are rejected or kept as
each operator states; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerframe.llm import decontamination, jaccard_join, mixing, pii, quality_classifier
from tellerframe.llm.words import unused
from tellerframe.sources.storage import materialize, materialize_alone

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more.  It learns from the labels of documents that are still
    here, without the held-out fold; without any it rejects nothing."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_classifier.fit(docs, labels.where(quality_classifier.fold(3) != 1), "quality")
    (score,) = unused(docs.columns, "score")
    return quality_classifier.scores(docs, model, score).where(F.col(score) >= 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of linked documents.  Rows are linked and removed as rows, by a written key, so that a
    repeated doc_id takes no other text with it and rows without doc_id are compared too.  Texts without words stay."""
    (key,) = unused(docs.columns, "row")
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed-rows")

    def others() -> DataFrame:
        found = jaccard_join.linked(rows.select(F.col(key).alias("doc_id"), "text"))
        return found.where("component_id != doc_id").select(F.col("doc_id").alias(key))

    # the sets and postings of the search would stay on disk through all later stages
    gone = materialize_alone(spark, others, "near-duplicates")
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data and terms that disclose it replaced, and n_chars to match."""
    return pii.sanitised(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes, sorted by training position, with size, source_size, target, taken and
    the position and words of each copy."""
    return mixing.curriculum(docs.withColumn("size", mixing.size_column())).where("taken > 0")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("PII", personal_data),
    ("mixing sources to target weights", mixed),
]

# The classifier's fit has no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
