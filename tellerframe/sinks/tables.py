"""Table writes and loads by mode."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerframe.operators.upsert import touched_partitions, upsert
from tellerframe.sources.raw import read_optional, read_parquet
from tellerframe.sources.storage import delete_path, materialize, path_exists, rename_path


def write_landing_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_staged(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


MONTH = "month_key"
_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def with_month(df: DataFrame, day: str) -> DataFrame:
    """``df`` plus its partition column, the month as the number yyyyMM."""
    return df.withColumn(MONTH, F.year(day) * 100 + F.month(day))


def write_by_month(df: DataFrame, path: str, day: str, cluster: Sequence[str]) -> None:
    """Month partitions, rows clustered inside each file; only the months in
    ``df`` are replaced."""
    overwrite_partitions(with_month(df, day), path, MONTH, cluster)


def _spread(df: DataFrame, partition: str, cluster: Sequence[str]) -> DataFrame:
    """Rows arranged for a partitioned write.

    The rebalance hint lets adaptive execution split a big partition over many
    tasks and merge small ones, so files come out near the advisory size
    instead of one per task and partition; sorted clusters make the row-group
    statistics selective.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def overwrite_partitions(df: DataFrame, path: str, partition: str, cluster: Sequence[str] = ()) -> None:
    """Replace the partitions ``df`` has rows for, leave the others."""
    spread = _spread(df, partition, cluster)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


@dataclass(frozen=True)
class Load:
    """How one staged dataset goes to its table."""

    dataset: str
    mode: str
    pk: tuple[str, ...]
    day: str | None = None  # the table goes by the months of this column


# Appending transactions would store a re-run twice; they are upserted.
STANDARD_LOADS = (
    Load("stg_customers", "replace", ("customer_id",)),
    Load("stg_accounts", "replace", ("account_id",)),
    Load("stg_transactions", "upsert", ("transaction_id",), "transaction_date"),
    Load("stg_credit", "replace", ("loan_id",)),
)


def replace_table(df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = ()) -> int:
    """Put ``df`` in place of the table at ``path``; returns its rows.

    The new table is written beside the old one and swapped in by a rename, so
    ``df`` may read the old one, and an empty frame leaves it alone.  The rows
    are observed during the write, without a pass of their own.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    rows = _write_counted(df, beside, "errorifexists", partition, cluster)
    if rows:
        rename_path(spark, beside, path)
    else:
        delete_path(spark, beside)
    return rows


def _write_counted(df: DataFrame, path: str, mode: str, partition: str | None, cluster: Sequence[str]) -> int:
    observed = Observation()
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    if partition:
        _spread(counted, partition, cluster).write.mode(mode).partitionBy(partition).parquet(path)
    else:
        counted.write.mode(mode).parquet(path)
    return observed.get["rows"]


def load_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    pk: Sequence[str] = (),
    partition: str | None = None,
    cluster: Sequence[str] = (),
    keys: DataFrame | None = None,
) -> int:
    """Write ``df`` to the table at ``path``, by ``partition`` and sorted by
    ``cluster`` if given; returns the rows given.  An empty frame changes
    nothing.  ``keys``, for a partitioned upsert, are those that arrived: a
    stored frame with ``pk``; rows of theirs that ``df`` has no more go."""
    if mode not in ("replace", "append", "upsert"):
        raise ValueError(f"unknown load mode {mode!r}")
    if mode == "upsert" and not pk:
        raise ValueError("upsert needs primary-key columns")
    if mode == "replace":
        return replace_table(df, path, partition, cluster)
    if mode == "append":
        if path_exists(df.sparkSession, path):
            return _write_counted(df, path, "append", partition, cluster)
        return replace_table(df, path, partition, cluster)
    # columns added by an earlier load may be missing from the oldest files
    target = read_optional(df.sparkSession, path, merge_schema=True)
    if target is None:
        return replace_table(df, path, partition, cluster)
    # the batch is written once; everything below reads that copy
    batch = materialize(df, "batch")
    rows = batch.count()
    if partition and (rows or keys is not None):
        merge_partitions(target, batch, path, pk, partition, cluster=cluster, keys=keys)
    elif rows:
        replace_table(upsert(target, batch, pk), path)
    return rows


def merge_partitions(
    target: DataFrame,
    batch: DataFrame,
    path: str,
    pk: Sequence[str],
    partition: str,
    version: str | None = None,
    cluster: Sequence[str] = (),
    keys: DataFrame | None = None,
) -> None:
    """Upsert that rewrites only the partitions the batch touches.

    The write reads the files it replaces: a dynamic overwrite moves the new
    files in when the job commits, and until then the old ones stay.
    ``batch`` is a stored table, as it is read more than once.
    """
    before, after = touched_partitions(target, batch, pk, partition, keys)
    if not before | after:
        return
    merged = upsert(target.filter(among(partition, before | after)), batch, pk, version, keys)
    left = before - after
    if left:
        # rows moved away from here; a partition they leave empty gets no new files
        left -= {row[0] for row in merged.filter(among(partition, left)).select(partition).distinct().collect()}
    overwrite_partitions(merged, path, partition, cluster)
    for value in left:
        drop_partition(batch.sparkSession, path, partition, value)


def drop_partition(spark: SparkSession, path: str, partition: str, value) -> None:
    delete_path(spark, f"{path}/{partition}={_HIVE_NULL if value is None else value}")


def among(column: str, values: set) -> Column:
    """``column`` in ``values``, null included; a literal list that prunes partitions."""
    inside = F.col(column).isin(*[v for v in values if v is not None])
    return inside | F.col(column).isNull() if None in values else inside


def load_all(datasets: dict[str, DataFrame], root: str, loads: Sequence[Load] = STANDARD_LOADS) -> dict[str, int]:
    """Load every dataset present by its own mode; rows per dataset."""
    return {load.dataset: _load(load, datasets[load.dataset], f"{root}/{load.dataset}") for load in loads if load.dataset in datasets}


def _load(load: Load, df: DataFrame, path: str) -> int:
    if load.day is None:
        return load_table(df, path, load.mode, load.pk)
    return load_table(with_month(df, load.day), path, load.mode, load.pk, MONTH, load.pk)


def append_evolving(df: DataFrame, path: str) -> DataFrame:
    """Append rows that may carry new columns; returns the merged table, in
    which older rows hold nulls for them."""
    df.write.mode("append").parquet(path)
    return read_parquet(df.sparkSession, path, merge_schema=True)
