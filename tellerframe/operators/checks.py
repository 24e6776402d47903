"""Declarative quality checks.

A check is a small record; :func:`run_checks` turns a list of them into one
row per check.  All row-local checks of a table share one aggregation pass, all
uniqueness and reference checks another one over its key columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerframe.functions.ratios import percent, ratio
from tellerframe.operators.median import exact_median
from tellerframe.schemas import BOOLEAN, INT, LONG, fields

QUARANTINE, HALT, FLAG, WARN = "QUARANTINE", "HALT", "FLAG", "WARN"
SAMPLES = 5

RESULT = T.StructType(
    [
        *fields("check_index", INT),
        *fields("check_name dimension column rule_description"),
        *fields("passed", BOOLEAN),
        *fields("failed_count", LONG),
        *fields("failed_pct", T.DecimalType(5, 2)),
        *fields("action details"),
    ]
)


@dataclass(frozen=True)
class Check:
    """One rule on one table.  Built by the functions below."""

    kind: str
    name: str
    dimension: str
    column: str | None
    rule: str
    action: str = QUARANTINE
    low: Decimal | int | None = None
    high: Decimal | int | None = None
    values: tuple[str, ...] = ()
    as_of: date | None = None
    mostly: Decimal = Decimal(1)
    reference: DataFrame | None = field(default=None, compare=False)
    reference_column: str | None = None
    every_copy: bool = False


def not_null(column: str, action: str = QUARANTINE) -> Check:
    return Check("not_null", f"not_null_{column}", "Completeness", column, f"Column '{column}' must not contain null values", action)


def unique(column: str, action: str = QUARANTINE, every_copy: bool = False) -> Check:
    """Counts the rows after the first of each value; with ``every_copy`` all
    rows of a repeated value, and nulls pass."""
    return Check(
        "unique", f"unique_{column}", "Uniqueness", column, f"Column '{column}' must contain unique values", action,
        every_copy=every_copy,
    )


def in_range(column: str, low=None, high=None, action: str = FLAG, mostly: Decimal = Decimal(1)) -> Check:
    """Inclusive bounds, either optional; nulls pass.  ``mostly`` is the share
    of non-null rows that has to pass."""
    return Check(
        "range", f"range_{column}", "Validity", column, f"'{column}' must be between {low} and {high}", action,
        low=low, high=high, mostly=mostly,
    )


def allowed(column: str, values: Sequence[str], action: str = FLAG) -> Check:
    values = tuple(sorted(values))
    return Check(
        "allowed", f"allowed_values_{column}", "Validity", column, f"'{column}' must be one of: {', '.join(values)}", action,
        values=values,
    )


def references(column: str, table: DataFrame, table_column: str | None = None, action: str = QUARANTINE) -> Check:
    """Every non-null value occurs in ``table``; a join, never a driver-side set."""
    return Check(
        "reference", f"referential_integrity_{column}", "Referential Integrity", column,
        f"All '{column}' values must exist in the reference table", action,
        reference=table, reference_column=table_column or column,
    )


def fresh(column: str, max_age_days: int, as_of: date, action: str = WARN) -> Check:
    return Check(
        "freshness", f"freshness_{column}", "Freshness", column, f"'{column}' values must be within {max_age_days} days", action,
        high=max_age_days, as_of=as_of,
    )


def row_count(low: int, high: int, action: str = FLAG) -> Check:
    return Check("row_count", "row_count", "Volume", None, f"Row count must be between {low} and {high}", action, low=low, high=high)


def exists(column: str, action: str = HALT) -> Check:
    return Check("exists", f"exists_{column}", "Schema", column, f"Column '{column}' must exist", action)


def mean_between(column: str, low, high, action: str = FLAG) -> Check:
    return Check("mean", f"mean_{column}", "Distribution", column, f"Mean of '{column}' must be between {low} and {high}", action, low=low, high=high)


def median_between(column: str, low, high, action: str = FLAG) -> Check:
    return Check("median", f"median_{column}", "Distribution", column, f"Median of '{column}' must be between {low} and {high}", action, low=low, high=high)


# ---- evaluation ------------------------------------------------------------


def violation(check: Check) -> Column | None:
    """Row-level predicate, true where the row breaks the rule; None for
    checks that are not decided row by row."""
    if check.column is None:
        return None
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "range":
        outside = F.lit(False)
        if check.low is not None:
            outside = outside | (value < check.low)
        if check.high is not None:
            outside = outside | (value > check.high)
        return F.coalesce(outside, F.lit(False))
    if check.kind == "allowed":
        return value.isNotNull() & ~F.coalesce(value.isin(*check.values), F.lit(False))
    if check.kind == "freshness":
        age = F.datediff(F.lit(check.as_of), value.try_cast("date"))
        return F.coalesce(age > check.high, F.lit(False))
    return None


def applicable(df: DataFrame, checks: Sequence[Check]) -> list[Check]:
    """Checks whose column exists; the others are skipped, except ``exists``
    itself and ranges, where a missing column is an error."""
    kept = []
    for check in checks:
        if check.kind == "exists" or check.column is None or check.column in df.columns:
            kept.append(check)
        elif check.kind == "range":
            raise ValueError(f"range check on missing column {check.column!r}")
    return kept


def _outcome(index: int, check: Check, failed: Column, total: Column, details: Column, passed: Column | None = None) -> Column:
    return F.struct(
        F.lit(index).alias("check_index"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.dimension).alias("dimension"),
        F.lit(check.column).cast("string").alias("column"),
        F.lit(check.rule).alias("rule_description"),
        (failed == 0 if passed is None else passed).alias("passed"),
        failed.cast("long").alias("failed_count"),
        F.coalesce(percent(failed, total), F.lit(0)).cast("decimal(5,2)").alias("failed_pct"),
        F.lit(check.action).alias("action"),
        details.cast("string").alias("details"),
    )


def _count_text(failed: Column, before: str, after: str) -> Column:
    return F.when(failed == 0, "OK").otherwise(F.concat(F.lit(before), failed.cast("string"), F.lit(after)))


def _single_pass(df: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """All row-local and whole-table checks in one aggregation."""
    measures = {"_rows": F.count(F.lit(1))}
    for i, check in numbered:
        broken = violation(check)
        if broken is not None:
            measures[f"_bad{i}"] = F.count_if(broken)
        if check.kind in ("range", "mean"):
            measures[f"_n{i}"] = F.count(check.column)
        if check.kind == "mean":
            measures[f"_sum{i}"] = F.sum(F.col(check.column).cast("decimal(28,4)"))
        if check.kind == "freshness":
            measures[f"_min{i}"] = F.min(F.col(check.column).try_cast("date"))
    totals = df.agg(*[expression.alias(name) for name, expression in measures.items()])

    rows = F.col("_rows")
    outcomes = []
    for i, check in numbered:
        passed = None
        if check.kind == "exists":
            present = check.column in df.columns
            failed, details = F.lit(0 if present else 1), F.lit("OK" if present else "Column is missing")
            outcomes.append(_outcome(i, check, failed, F.lit(1), details))
            continue
        if check.kind == "row_count":
            failed = F.when(rows.between(check.low, check.high), 0).otherwise(1)
            outcomes.append(_outcome(i, check, failed, F.lit(1), F.concat(F.lit("Rows: "), rows.cast("string"))))
            continue
        if check.kind == "mean":
            average = ratio(F.col(f"_sum{i}"), F.col(f"_n{i}"), 4)
            outcomes.append(_observed(i, check, average, "Mean: "))
            continue
        failed = F.col(f"_bad{i}")
        if check.kind == "not_null":
            details = _count_text(failed, "Nulls found in ", " rows")
        elif check.kind == "range":
            details = _count_text(failed, "", " values outside expected range")
            if check.mostly < 1:
                passed = failed <= F.col(f"_n{i}") * (1 - check.mostly)
        elif check.kind == "allowed":
            details = _count_text(failed, "", " invalid values")
        else:
            oldest = F.col(f"_min{i}")
            details = F.coalesce(F.concat(F.lit("Oldest record: "), oldest.cast("string")), F.lit("No valid dates"))
        outcomes.append(_outcome(i, check, failed, rows, details, passed))
    return totals.select(F.explode(F.array(*outcomes)).alias("r")).select("r.*")


def _observed(index: int, check: Check, value: Column, label: str) -> Column:
    """Outcome of a rule on one figure of the whole table; no figure fails it."""
    inside = F.coalesce(value.between(check.low, check.high), F.lit(False))
    details = F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit("none")))
    return _outcome(index, check, F.when(inside, 0).otherwise(1), F.lit(1), details)


def orphan_keys(df: DataFrame, column: str, table: DataFrame, table_column: str) -> DataFrame:
    """Non-null values of ``column`` absent from the reference, with row counts.

    The values are counted before the anti join, so neither a hot valid key
    nor a hot orphan crosses the join more than once.
    """
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    known = table.select(F.col(table_column).alias(column))
    return used.join(known, column, "left_anti")


def _keyed(df: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """All uniqueness and reference checks of a table in one pass over it.

    The key columns of a row become rows (check, key), those of the references too, marked as theirs.  One
    aggregate counts both sides of every key, in partial counts before its shuffle, so a key
    of a third of all rows is one row per map task; duplicates and orphans are read from the counts.
    """
    keys = _key_counts(df, numbered)
    repeated, present, orphan = F.col("_n") > 1, F.col("_key").isNotNull(), F.col("_key").isNotNull() & (F.col("_known") == 0)
    figures = {
        "rows": F.sum("_n"),
        "copies": F.sum(F.col("_n") - 1),
        "every_copy": F.coalesce(F.sum(F.when(repeated & present, F.col("_n"))), F.lit(0)),
        "orphans": F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)),
        "orphan_keys": F.count_if(orphan),
    }
    totals = keys.groupBy("_check").agg(*[e.alias(n) for n, e in figures.items()])
    # one row for each check; an empty table has none
    by_check = F.map_from_entries(F.collect_list(F.struct("_check", F.struct(*figures))))
    outcomes = []
    for i, check in numbered:
        found = F.col("_totals")[i]
        if check.kind == "unique":
            bad = F.coalesce(found["every_copy" if check.every_copy else "copies"], F.lit(0))
            details = _count_text(bad, "", " duplicate rows detected")
        else:
            bad = F.coalesce(found["orphans"], F.lit(0))
            details = F.when(bad == 0, "OK").otherwise(F.concat(F.lit("Orphan keys: "), found["orphan_keys"].cast("string")))
        outcomes.append(_outcome(i, check, bad, found["rows"], details))
    return totals.agg(by_check.alias("_totals")).select(F.inline(F.array(*outcomes)))


def _key_counts(df: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """(_check, _key) of the rows, with their number and whether the reference knows the key; for a uniqueness check
    every key counts as known."""
    side = F.struct
    own = [
        side(
            F.lit(i).alias("_check"),
            F.col(c.column).cast("string").alias("_key"),
            F.lit(1).cast("long").alias("_own"),
            F.lit(0 if c.kind == "reference" else 1).alias("_known"),
        )
        for i, c in numbered
    ]
    tagged = df.select(F.inline(F.array(*own)))
    types = dict(df.dtypes)
    for i, check in numbered:
        if check.kind == "reference":
            key = F.col(check.reference_column).cast(types[check.column]).cast("string")
            known = check.reference.select(F.lit(i).alias("_check"), key.alias("_key"), F.lit(0).cast("long").alias("_own"), F.lit(1).alias("_known"))
            tagged = tagged.unionByName(known)
    return tagged.groupBy("_check", "_key").agg(F.sum("_own").alias("_n"), F.max("_known").alias("_known")).filter("_n > 0")


def _median(df: DataFrame, index: int, check: Check) -> DataFrame:
    # an empty column yields no row; the aggregate turns that into a null
    figure = exact_median(df, check.column).agg(F.max("median").alias("_m"))
    return figure.select(_observed(index, check, F.col("_m"), "Median: ").alias("r")).select("r.*")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per applicable check, in the order given (``check_index``)."""
    numbered = list(enumerate(applicable(df, checks)))
    keyed = [(i, c) for i, c in numbered if c.kind in ("unique", "reference")]
    local = [(i, c) for i, c in numbered if c.kind not in ("unique", "reference", "median")]
    parts = [whole(df, some) for whole, some in ((_single_pass, local), (_keyed, keyed)) if some]
    parts += [_median(df, i, c) for i, c in numbered if c.kind == "median"]
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _offenders(df: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame | None:
    """Distinct (check_index, _label, _value) of values outside a value set, all
    sets in one pass, and of orphan keys, from the counts that the results are read from."""
    parts = []
    sets = [(i, c) for i, c in numbered if c.kind == "allowed"]
    if sets:
        broken = [
            F.when(
                violation(c),
                F.struct(
                    F.lit(i).alias("check_index"),
                    F.lit("Invalid values").alias("_label"),
                    F.col(c.column).cast("string").alias("_value"),
                ),
            )
            for i, c in sets
        ]
        parts.append(df.select(F.inline(F.array_compact(F.array(*broken)))).distinct())
    keyed = [(i, c) for i, c in numbered if c.kind in ("unique", "reference")]
    if any(c.kind == "reference" for _, c in keyed):
        # a condition on the count leaves the counting as in the results, so that its shuffle is reused
        orphans = _key_counts(df, keyed).filter((F.when(F.col("_key").isNotNull(), F.col("_n")) > 0) & (F.col("_known") == 0))
        parts.append(orphans.select(F.col("_check").alias("check_index"), F.lit("Orphan keys").alias("_label"), F.col("_key").alias("_value")))
    union = parts[0] if parts else None
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def with_samples(results: DataFrame, df: DataFrame, checks: Sequence[Check], limit: int = SAMPLES) -> DataFrame:
    """Results whose failed value-set and reference checks name a few offenders."""
    offenders = _offenders(df, list(enumerate(applicable(df, checks))))
    if offenders is None:
        return results
    rank = F.row_number().over(Window.partitionBy("check_index", "_label").orderBy("_value"))
    listed = (
        offenders.withColumn("_rank", rank)
        .filter(F.col("_rank") <= limit)
        .groupBy("check_index", "_label")
        .agg(F.sort_array(F.collect_list("_value")).alias("_values"))
        .select("check_index", F.concat("_label", F.lit(": "), F.array_join("_values", ", ")).alias("_listed"))
    )
    named = F.when(F.col("passed") | F.col("_listed").isNull(), F.col("details")).otherwise(F.col("_listed"))
    return results.join(listed, "check_index", "left").withColumn("details", named).select(*results.columns)
