"""Raw landing files and named raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerframe.operators.dedup import INGEST_ORDER
from tellerframe.schemas import RAW_FEEDS
from tellerframe.sources.storage import materialize, path_exists

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with header under a declared schema; with ``keep_corrupt`` a row that
    does not fit keeps its text in ``_corrupt_record``."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_feed_csv(spark: SparkSession, folder: str, feed: str) -> DataFrame:
    return read_raw_csv(spark, f"{folder}/{feed}.csv", RAW_FEEDS[feed])


def land_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, text of those that do not) of a landing file,
    from one written copy: no row turns into nulls unseen."""
    landed = materialize(read_raw_csv(spark, path, schema, keep_corrupt=True), "landed")
    return landed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), landed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_optional(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none."""
    return read_parquet(spark, path, merge_schema) if path_exists(spark, path) else None


def register_raw(feeds: dict[str, DataFrame]) -> None:
    """Expose raw frames by name, so that ``spark.table`` and SQL find them."""
    for name, df in feeds.items():
        df.createOrReplaceTempView(name)


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Number the rows in read order, once, in a written table.

    The number is fixed when written; computed twice it could differ.  It follows how
    Spark packs files into tasks; see :func:`with_file_order` for rows of files.
    """
    return materialize(df.withColumn(INGEST_ORDER, F.monotonically_increasing_id()), "ingest")


def with_file_order(df: DataFrame) -> DataFrame:
    """Number the rows of files by file name and place in the file, however many tasks read them.

    A piece of a file is read by one task in its order, so the running number within the piece is kept and the rows of
    all pieces before are added.  Only the list of pieces, with their counts, goes through one task.  ``df`` is
    read from files directly, without joins or aggregates between.
    """
    landed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_read"),
    )
    landed = materialize(landed, "landed-pieces")
    pieces = landed.groupBy("_file", "_block").agg(F.min("_read").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    offsets = materialize(pieces.select("_file", "_block", start.alias("_start")), "pieces")
    numbered = landed.join(offsets, ["_file", "_block"]).withColumn(INGEST_ORDER, F.col("_read") + F.col("_start"))
    return materialize(numbered.drop("_file", "_block", "_read", "_start"), "ingest")


def land_feed(spark: SparkSession, folder: str, feed: str) -> tuple[DataFrame, DataFrame]:
    """(rows of a feed's CSV that fit its schema, numbered in file order; number and text of those that do not)."""
    numbered = with_file_order(read_raw_csv(spark, f"{folder}/{feed}.csv", RAW_FEEDS[feed], keep_corrupt=True))
    corrupt = F.col(CORRUPT).isNotNull()
    return numbered.filter(~corrupt).drop(CORRUPT), numbered.filter(corrupt).select(INGEST_ORDER, CORRUPT)


def inventory(datasets: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset: name, rows, columns."""
    counts = None
    for name, df in datasets.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts


def optional_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Inventory of staged tables that may be absent: those report ``skipped``."""
    report = None
    for name, path in paths.items():
        df = read_optional(spark, path)
        if df is None:
            row = spark.range(1).select(
                F.lit(name).alias("dataset"), F.lit("skipped").alias("status"), F.lit(None).cast("long").alias("row_count")
            )
        else:
            row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("dataset"), F.lit("loaded").alias("status"), "row_count"
            )
        report = row if report is None else report.unionByName(row)
    return report
