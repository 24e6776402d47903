"""Raw transaction files to the staged table, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tellerframe.config import Rules
from tellerframe.operators.dedup import dedup_first
from tellerframe.plans.staging import stage_transactions
from tellerframe.sinks.tables import MONTH, merge_partitions, overwrite_partitions, with_month
from tellerframe.sources.raw import read_optional
from tellerframe.sources.storage import materialize, working

Merge = Callable[[DataFrame], None]


def read_landing(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files dropped into a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def merge_batch(batch: DataFrame, path: str, rules: Rules) -> None:
    """Stage one micro-batch and merge it into the table at ``path``.

    The newer extract of an id wins whatever order the batches come in, so a
    batch that is run again after a failure changes nothing.  Only the months
    the batch touches are rewritten.
    """
    spark = batch.sparkSession
    with working(spark):
        staged = with_month(stage_transactions(batch, rules, keep_version=True), "transaction_date")
        staged = materialize(staged, "stream-batch")
        target = read_optional(spark, path, merge_schema=True)
        if target is None:
            overwrite_partitions(staged, path, MONTH)
        else:
            merge_partitions(target, staged, path, ["transaction_id"], MONTH, version="extract_ts")


def ingest(raw: DataFrame, path: str, checkpoint: str, rules: Rules) -> StreamingQuery:
    """Merge everything that has arrived, then stop; schedule it as often as
    the feed is due (every 15 minutes in the catalog)."""
    return (
        raw.writeStream.foreachBatch(lambda batch, _: merge_batch(batch, path, rules))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(raw: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """One row per id among rows less than ``delay`` apart in event time.

    State is kept for the delay only.  Ids that return later need the merge
    above, which compares against the whole table.  Rows later than the delay are dropped; see :func:`dedup_keeping_late`.
    """
    return raw.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def split_batch(batch: DataFrame, batch_id: int, key: str, event_time: str, delay: str, path: str, merge_late: Merge | None = None) -> None:
    """One micro-batch into rows to keep, copies and late rows, with their counts.

    Late is what lies more than ``delay`` before the newest event of the batches before; the first batch has none, and rows
    without an event time are in time.  Of the others the earliest of an id is kept, unless a batch before kept one
    of that id inside the delay.  Kept rows, late rows and counts are stored below ``path`` by batch, and a batch reads only those
    of smaller number: run again after a failure, it writes the same.  Late rows go to ``merge_late``.
    """
    spark = batch.sparkSession
    with working(spark):
        rows = materialize(batch, "stream-batch")
        before = _earlier(spark, f"{path}/counts", batch_id)
        mark = None if before is None else before.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]
        late = F.coalesce(F.col(event_time) < F.lit(mark), F.lit(False)) if mark else F.lit(False)
        order = F.struct(event_time, *[c for c in rows.columns if c not in (key, event_time)])
        first = dedup_first(rows.filter(~late).withColumn("_order", order), [key], "_order").drop("_order")
        known = _earlier(spark, f"{path}/kept", batch_id)
        if known is not None:
            inside = known.filter(F.col(event_time) >= F.lit(mark)) if mark else known
            ids = inside.select(F.col(key).alias("_key"))
            first = first.join(ids, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        of_batch = lambda name: f"{path}/{name}/batch_id={batch_id}"
        first.write.mode("overwrite").parquet(of_batch("kept"))
        rows.filter(late).write.mode("overwrite").parquet(of_batch("late"))
        if merge_late:
            merge_late(spark.read.schema(rows.schema).parquet(of_batch("late")))
        kept = spark.read.schema(rows.schema).parquet(of_batch("kept")).agg(F.count(F.lit(1)).alias("kept"))
        counts = rows.agg(F.max(event_time).alias("newest"), F.count(F.lit(1)).alias("rows_in"), F.count_if(late).alias("late"))
        counted = counts.join(kept).withColumn("duplicates", F.col("rows_in") - F.col("kept") - F.col("late"))
        counted.write.mode("overwrite").parquet(of_batch("counts"))


def _earlier(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    stored = read_optional(spark, path) if batch_id else None
    return None if stored is None else stored.filter(F.col("batch_id") < batch_id).drop("batch_id")


def dedup_keeping_late(
    raw: DataFrame, key: str, event_time: str, delay: str, path: str, checkpoint: str, merge_late: Merge | None = None
) -> StreamingQuery:
    """Dedup of a stream by :func:`split_batch`: no row vanishes uncounted, ``path``/counts tells where each went."""
    return (
        raw.writeStream.foreachBatch(lambda batch, number: split_batch(batch, number, key, event_time, delay, path, merge_late))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
