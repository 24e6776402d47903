"""One row per key.

``dedup_latest`` and ``dedup_first`` are ranked windows filtered to their first
row, planned with a partial group limit: every map task keeps one row per key
before the shuffle, so a key that holds a third of all rows costs each reducer
one row per map task.  The wide rows are still shuffled and sorted.

``dedup_sparse`` spares that where few keys repeat, as in a sound feed.  A
narrow pass finds the repeated keys; rows of all other keys pass through
without a shuffle, and only the copies are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerframe.sources.storage import materialize

_RANK = "_row_rank"
INGEST_ORDER = "_ingest_order"


def _keep_best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_latest(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] | None = None) -> DataFrame:
    """The row with the highest ``version`` per key.

    Ties go to the row read first where the feed carries ``_ingest_order``;
    that also lets Catalyst prune the columns a query does not use.  Without
    it all columns break ties: rows still tied are then identical.
    """
    if ties is None:
        every = [c for c in df.columns if c not in (*keys, version)]
        ties = [INGEST_ORDER] if INGEST_ORDER in df.columns else every
    return _keep_best(df, keys, [F.desc(version), *[F.asc(c) for c in ties]])


def dedup_first(df: DataFrame, keys: Sequence[str], order: str = INGEST_ORDER) -> DataFrame:
    """The row read first per key; null keys form one group."""
    return _keep_best(df, keys, [F.asc(order)])


def dedup_sparse(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] | None = None) -> DataFrame:
    """Same result as :func:`dedup_latest`, for inputs read from stored tables
    (they are scanned three times, once for the keys alone).  The repeated keys are
    a written table, from whose size Catalyst chooses the joins."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    repeated = materialize(repeated.select(*[F.col(k).alias(f"_{k}") for k in keys]), "repeated-keys")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    copies = df.join(repeated, same, "left_semi")
    return df.join(repeated, same, "left_anti").unionByName(dedup_latest(copies, keys, version, ties))


def kept_of_repeated(df: DataFrame, key: str, version: str | None, order: str = INGEST_ORDER) -> DataFrame:
    """For keys that occur more than once: the key and the read position of the
    row to keep, that with the highest ``version``, of those the one read first;
    without ``version`` the one read first.

    A mergeable aggregate over narrow columns; the result is as small as the
    feed is clean.
    """
    kept = F.min(order) if version is None else -F.max(F.struct(F.col(version), -F.col(order)))["col2"]
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_copies"), kept.alias("_kept"))
        .filter(F.col("_copies") > 1)
        .select(key, "_kept")
    )
