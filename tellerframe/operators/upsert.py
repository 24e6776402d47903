"""Replacing rows by primary key on plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerframe.operators.dedup import dedup_latest


def matching(target: DataFrame, keys: DataFrame, pk: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on the key columns; a null key equals a null key, so
    that a load run twice replaces its rows in any case."""
    named = keys.select(*[F.col(c).alias(f"_key_{c}") for c in pk]).distinct()
    same = F.lit(True)
    for column in pk:
        same = same & F.col(column).eqNullSafe(F.col(f"_key_{column}"))
    return target.join(named, same, how)


def upsert(
    target: DataFrame, batch: DataFrame, pk: Sequence[str], version: str | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """``target`` with the rows of ``batch`` in place of those with equal keys.

    Columns only one side has are kept and null on the other.  With
    ``version`` the newer row wins instead of the batch, so batches may arrive
    in any order.  ``keys`` are keys whose rows go from the target even if the
    batch has none for them.
    """
    if not pk:
        raise ValueError("upsert needs primary-key columns")
    if version is not None:
        return dedup_latest(target.unionByName(batch, allowMissingColumns=True), pk, version)
    kept = matching(target, batch if keys is None else keys, pk, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def within_bounds(target: DataFrame, batch: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Target rows inside the least and greatest key of the batch, or without
    a key, as literal predicates that reach the Parquet statistics."""
    bounds = batch.agg(*[f(c).alias(f"{n}_{c}") for c in pk for n, f in (("low", F.min), ("high", F.max))]).first()
    for column in pk:
        inside = F.col(column).between(F.lit(bounds[f"low_{column}"]), F.lit(bounds[f"high_{column}"]))
        target = target.filter(F.col(column).isNull() | inside)
    return target


def touched_partitions(
    target: DataFrame, batch: DataFrame, pk: Sequence[str], partition: str, keys: DataFrame | None = None
) -> tuple[set, set]:
    """Partition values that hold keys of the batch (before, after) the load.

    Only these have to be rewritten.  The sets are as long as the table has
    partitions, i.e. metadata, not data.  The search reads the key columns
    only, and only files whose statistics overlap the key range of the batch;
    where ids grow with time that leaves the recent ones.
    """
    keys = batch if keys is None else keys
    before = matching(within_bounds(target, keys, pk), keys, pk, "left_semi")
    return tuple({row[0] for row in df.select(partition).distinct().collect()} for df in (before, batch))


def high_water_mark(target: DataFrame, column: str):
    """Greatest loaded value of an arrival column, None for an empty target."""
    return target.agg(F.max(column)).first()[0]


def newer_than(source: DataFrame, column: str, mark) -> DataFrame:
    """Rows that arrived with or after the mark; a later upsert makes loading the
    mark's own rows again harmless.  ``column`` says when a row arrived, never
    what day it is about: late rows and corrections of old days arrive like any
    other.  Rows without it are taken every time; no mark means everything."""
    if mark is None:
        return source
    return source.filter(F.col(column).isNull() | (F.col(column) >= F.lit(mark)))
