"""Dimension history (SCD type 2) and point-in-time lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerframe.functions.keys import surrogate_key
from tellerframe.sources.raw import read_optional
from tellerframe.sources.storage import materialize

VALIDITY = ("effective_from", "effective_to", "is_current")
VERSION = "version_sk"
LOAD_DAY = "load_day"


def start_history(staged: DataFrame, key: str, sk: str, as_of: date) -> DataFrame:
    """First load: every row is the current version, valid from ``as_of``.

    ``sk`` is durable: all versions of a key share it, and facts carry it, so that a
    new version takes no fact away.  ``version_sk`` is the version's own key.
    """
    return staged.select(
        surrogate_key(F.col(key)).alias(sk),
        surrogate_key(F.col(key), F.lit(as_of)).alias(VERSION),
        *staged.columns,
        F.lit(as_of).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def merge_history(
    dimension: DataFrame, staged: DataFrame, key: str, sk: str, tracked: Sequence[str], as_of: date
) -> DataFrame:
    """The dimension after a load on ``as_of``.

    A staged row whose tracked columns differ closes the current version
    (``effective_to`` is exclusive) and opens a new one; unseen keys are
    inserted; keys missing from the batch stay as they are.  Columns that are
    not tracked are refreshed on the current version.  A version opened on
    ``as_of`` itself is replaced rather than closed, so a load run twice leaves
    the same table.

    One full outer join on the natural key, which staging makes unique; each
    matched pair yields its one or two versions from the same row.
    """
    fresh = start_history(staged, key, sk, as_of)
    columns = fresh.columns
    old, new = F.col("old"), F.col("new")
    current = dimension.filter("is_current").select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    batch = fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))

    changed = F.lit(False)
    for name in tracked:
        changed = changed | ~old[name].eqNullSafe(new[name])
    closed = old.withField("effective_to", F.lit(as_of)).withField("is_current", F.lit(False))
    refreshed = new.withField("effective_from", old["effective_from"]).withField(VERSION, old[VERSION])
    versions = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull(), F.array(old))
        .when(~changed, F.array(refreshed))
        .when(old["effective_from"] >= F.lit(as_of), F.array(new))
        .otherwise(F.array(closed, new))
    )
    merged = current.join(batch, "_key", "full_outer").select(F.explode(versions).alias("version")).select("version.*")
    return dimension.filter(~F.col("is_current")).select(*columns).unionByName(merged)


def record_load(staged: DataFrame, log: str, as_of: date) -> None:
    """Keep what a load said in the log of loads, one partition a day; a load of a day already there takes its place."""
    staged.write.mode("overwrite").parquet(f"{log}/{LOAD_DAY}={as_of.isoformat()}")


def _seed_log(dimension: DataFrame, columns: Sequence[str], log: str) -> None:
    """A log for a dimension that has none yet: every version was said on the day it began."""
    said = dimension.select(*columns, F.col("effective_from").alias(LOAD_DAY))
    said.write.mode("overwrite").partitionBy(LOAD_DAY).parquet(log)


def timeline(log: DataFrame, key: str, sk: str, tracked: Sequence[str]) -> DataFrame:
    """The versions that loads of any days make, whatever the order they came in.

    The loads of a key stand on one timeline.  Neighbours with equal tracked columns are one version, which holds the
    untracked columns of its last load; a version ends where the next begins.  All windows and the
    aggregate go by the key, so the log is shuffled once.
    """
    columns = [c for c in log.columns if c != LOAD_DAY]
    by_day = Window.partitionBy(key).orderBy(LOAD_DAY)
    state = F.struct(*tracked)
    opens = ~F.lag(state).over(by_day).eqNullSafe(state)
    numbered = log.withColumn("_opens", opens.cast("int")).withColumn("_version", F.sum("_opens").over(by_day))
    versions = numbered.groupBy(key, "_version").agg(
        F.min(LOAD_DAY).alias("effective_from"), F.max_by(F.struct(*columns), LOAD_DAY).alias("_row")
    )
    until = F.lead("effective_from").over(Window.partitionBy(key).orderBy("effective_from"))
    return versions.withColumn("effective_to", until).select(
        surrogate_key(F.col(key)).alias(sk),
        surrogate_key(F.col(key), F.col("effective_from")).alias(VERSION),
        *[F.col("_row")[c].alias(c) for c in columns],
        "effective_from",
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
    )


def load_history(
    dimension: DataFrame | None, staged: DataFrame, key: str, sk: str, tracked: Sequence[str], as_of: date, log: str
) -> DataFrame:
    """The dimension after a load of any day, which is added to the log at the path ``log``.

    A load newer than all before it is merged with the current versions.  An older one, or one of a day that was
    loaded before, rebuilds the timelines of the keys it has or had from the log; other keys stay.  The
    table is then that of the same loads in the order of their days.
    """
    spark = staged.sparkSession
    loads = read_optional(spark, log)
    if loads is None and dimension is not None:
        _seed_log(dimension, staged.columns, log)
        loads = read_optional(spark, log)
    newest = loads.agg(F.max(LOAD_DAY)).first()[0] if loads is not None else None
    if newest is None or newest < as_of:
        record_load(staged, log, as_of)
        return start_history(staged, key, sk, as_of) if dimension is None else merge_history(dimension, staged, key, sk, tracked, as_of)
    replaced = loads.filter(F.col(LOAD_DAY) == F.lit(as_of))
    keys = materialize(staged.select(key).unionByName(replaced.select(key)).distinct().withColumnRenamed(key, "_key"), "loaded-keys")
    record_load(staged, log, as_of)
    return _rebuilt(spark, dimension, keys, key, sk, tracked, log)


def _rebuilt(
    spark: SparkSession, dimension: DataFrame | None, keys: DataFrame, key: str, sk: str, tracked: Sequence[str], log: str
) -> DataFrame:
    same = F.col(key).eqNullSafe(F.col("_key"))
    versions = timeline(read_optional(spark, log).join(keys, same, "left_semi"), key, sk, tracked)
    if dimension is None:
        return versions
    return dimension.join(keys, same, "left_anti").select(*versions.columns).unionByName(versions)


def as_of_join(facts: DataFrame, dimension: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Facts with the dimension columns valid on the fact's own day.

    The equality on ``key`` keeps it a hash or merge join; validity is a
    residual condition, evaluated inside the join.  Facts before the first
    version keep nulls.  Each fact meets all versions of its key: for keys
    with many versions there is :func:`as_of_fill`.
    """
    versions = dimension.select(F.col(key).alias("_dim_key"), "effective_from", "effective_to", *columns)
    return facts.join(
        versions,
        (F.col(key) == F.col("_dim_key"))
        & (F.col(day) >= F.col("effective_from"))
        & (F.col("effective_to").isNull() | (F.col(day) < F.col("effective_to"))),
        "left",
    ).drop("_dim_key", "effective_from", "effective_to")


def as_of_fill(facts: DataFrame, dimension: DataFrame, key: str, day: str, columns: Sequence[str], slice_by: str = "month") -> DataFrame:
    """The rows of :func:`as_of_join` for keys with any number of versions.

    The distinct (key, day) of the facts and the versions stand on one timeline, on which the last version is
    carried forward; the facts then take theirs by an equi join on key and day, which adaptive execution splits
    where a key is hot.  A timeline is cut into slices of time (a unit of ``date_trunc``), each of which begins with the version it inherits: a
    hot key is as many groups as slices, and only one row for each slice is ordered over the whole key.
    """
    moment = facts.schema[day].dataType
    at = F.col("_day")
    valid = F.col("effective_to").isNull() | (F.col("effective_from") < F.col("effective_to"))
    asked = facts.select(F.col(key).alias("_key"), F.col(day).alias("_day")).dropna().distinct()
    known = dimension.filter(valid).select(
        F.col(key).alias("_key"), F.col("effective_from").cast(moment).alias("_day"), F.struct("effective_to", *columns).alias("_version")
    )
    known = known.dropna(subset=["_key", "_day"])
    nothing = F.lit(None).cast(known.schema["_version"].dataType)
    timeline_rows = (
        known.withColumn("_kind", F.lit(1))
        .unionByName(asked.select("_key", "_day", nothing.alias("_version"), F.lit(2).alias("_kind")))
        .withColumn("_slice", F.date_trunc(slice_by, at))
    )
    slices = timeline_rows.groupBy("_key", "_slice").agg(F.max_by("_version", F.when(F.col("_kind") == 1, at)).alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = slices.select(
        "_key", F.col("_slice").cast(moment).alias("_day"), F.last("_last", ignorenulls=True).over(earlier).alias("_version"), F.lit(0).alias("_kind"), "_slice"
    ).filter("_version is not null")
    so_far = Window.partitionBy("_key", "_slice").orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = timeline_rows.unionByName(inherited).withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter("_kind = 2")
    ends = F.col("_version")["effective_to"]
    filled = filled.select("_key", "_day", F.when(ends.isNull() | (at < ends), F.col("_version")).alias("_version"))
    joined = facts.join(filled, (F.col(key) == F.col("_key")) & (F.col(day) == at), "left")
    return joined.select(*facts.columns, *[F.col("_version")[c].alias(c) for c in columns])
