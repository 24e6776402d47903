"""Column profiles of days, stored as sketches and merged over any range of days.

A stored row is one column of one day of a dataset: exact counts, least, greatest and sum, a sketch of its distinct
values and, for numbers, one of their distribution.  A range of days is profiled by merging its rows, without
the data; sketches have a bounded size whatever they saw, so the store grows with days and columns only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerframe.functions.ratios import percent

DAY = "profile_day"
_NUMBER = "decimal(38,6)"  # sums and extremes stay exact; money is never binary
# ours: shares of the values at which two distributions are compared
SHARES = tuple((2 * i + 1) / 200 for i in range(100))


def _cell(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)  # -0.0 and 0.0 are one value
    return value.cast("string")


def _figures(i: int, field: T.StructField) -> list[Column]:
    value = F.col(f"`{field.name}`")
    figures = [F.count_if(value.isNull()).alias(f"_nulls{i}"), F.hll_sketch_agg(_cell(field)).alias(f"_distinct{i}")]
    if isinstance(field.dataType, T.NumericType):
        exact = value.try_cast(_NUMBER)  # "not a number" and infinities have no place among exact figures
        figures += [
            F.count(exact).alias(f"_numbers{i}"),
            F.min(exact).alias(f"_least{i}"),
            F.max(exact).alias(f"_greatest{i}"),
            F.sum(exact).alias(f"_sum{i}"),
            F.kll_sketch_agg_double(exact.cast("double")).alias(f"_spread{i}"),
        ]
    return figures


def sketch_days(df: DataFrame, dataset: str, day: Column) -> DataFrame:
    """One row per day and column of ``df``, from one scan and one shuffle of a row per task and day."""
    fields = df.schema.fields
    totals = df.groupBy(day.cast("date").alias(DAY)).agg(
        F.count(F.lit(1)).alias("_rows"), *[figure for i, f in enumerate(fields) for figure in _figures(i, f)]
    )

    def figure(i: int, field: T.StructField, name: str, kind: str) -> Column:
        return F.col(f"_{name}{i}") if isinstance(field.dataType, T.NumericType) else F.lit(None).cast(kind)

    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("_rows").alias("total_count"),
            F.col(f"_nulls{i}").alias("null_count"),
            F.col(f"_distinct{i}").alias("distinct_sketch"),
            F.coalesce(figure(i, f, "numbers", "long"), F.lit(0)).alias("number_count"),
            figure(i, f, "least", _NUMBER).cast(_NUMBER).alias("min_value"),
            figure(i, f, "greatest", _NUMBER).cast(_NUMBER).alias("max_value"),
            figure(i, f, "sum", _NUMBER).cast(_NUMBER).alias("sum_value"),
            figure(i, f, "spread", "binary").alias("spread_sketch"),
        )
        for i, f in enumerate(fields)
    ]
    return totals.select(F.lit(dataset).alias("dataset"), DAY, F.inline(F.array(*rows)))


def store_day(df: DataFrame, dataset: str, day: date, path: str) -> None:
    """Keep the profile of what arrived on ``day``; a day stored before is replaced."""
    rows = sketch_days(df, dataset, F.lit(day)).drop("dataset", DAY)
    rows.write.mode("overwrite").parquet(f"{path}/dataset={dataset}/{DAY}={day.isoformat()}")


def merged(profiles: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Profiles over all stored days from ``first`` to ``last``: one row per dataset and column."""
    days = profiles
    if first is not None:
        days = days.filter(F.col(DAY) >= F.lit(first))
    if last is not None:
        days = days.filter(F.col(DAY) <= F.lit(last))
    return days.groupBy("dataset", "column_name").agg(
        F.max_by("dtype", DAY).alias("dtype"),
        F.sum("total_count").alias("total_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.sum("number_count").alias("number_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("sum_value").cast(_NUMBER).alias("sum_value"),
        F.kll_merge_agg_double("spread_sketch").alias("spread_sketch"),
    )


def _mean() -> Column:
    return F.round(F.try_divide(F.col("sum_value"), F.col("number_count")), 4).cast("decimal(38,4)")


def _quantile(sketch: Column, numbers: Column, share: float) -> Column:
    return F.when(numbers > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def summarised(merged_days: DataFrame) -> DataFrame:
    """Readable figures of merged profiles; distinct values and quartiles are estimates."""
    quartiles = [
        _quantile(F.col("spread_sketch"), F.col("number_count"), share).alias(name)
        for name, share in (("lower_quartile", 0.25), ("median", 0.5), ("upper_quartile", 0.75))
    ]
    return merged_days.select(
        "dataset", "column_name", "dtype", "total_count", "null_count",
        percent(F.col("null_count"), F.col("total_count")).alias("null_pct"),
        F.hll_sketch_estimate("distinct_sketch").alias("unique_count"),
        "min_value", "max_value", _mean().alias("mean_value"), *quartiles,
    )


def drift(base: DataFrame, other: DataFrame, most: float = 0.25) -> DataFrame:
    """How each column of ``other`` differs from ``base``, both merged profiles.

    ``distance`` is the largest difference, at a hundred quantiles of either side, between the shares of both sides'
    values up to there, in hundredths.  ``drifted`` tells whether it, or the change of the null share, exceeds ``most``.  A column
    that one side lacks, or that has no numbers on one side, has no distance.
    """
    figures = ["dtype", "total_count", "null_count", "number_count", "sum_value", "spread_sketch"]

    def side(profiles: DataFrame, name: str) -> DataFrame:
        nulls = F.try_divide(F.col("null_count"), F.col("total_count"))
        return profiles.select("dataset", "column_name", F.struct(*figures, nulls.alias("null_share"), _mean().alias("mean")).alias(name))

    pairs = side(base, "base").join(side(other, "other"), ["dataset", "column_name"], "full_outer")
    one, two = F.col("base"), F.col("other")
    both = (one["number_count"] > 0) & (two["number_count"] > 0)

    grids = [F.kll_sketch_get_quantile_double(s["spread_sketch"], F.array(*[F.lit(share) for share in SHARES])) for s in (one, two)]

    def apart(value: Column) -> Column:
        upto = [F.size(F.filter(grid, lambda v: v <= value)) for grid in grids]
        return F.abs(upto[0] - upto[1])

    distance = F.when(both, F.array_max(F.transform(F.concat(*grids), apart)) / len(SHARES))
    change = F.abs(two["null_share"] - one["null_share"])
    return pairs.select(
        "dataset", "column_name",
        F.coalesce(one["total_count"], F.lit(0)).alias("base_count"),
        F.coalesce(two["total_count"], F.lit(0)).alias("other_count"),
        (two["mean"] - one["mean"]).alias("mean_shift"),
        F.round(change, 6).alias("null_share_change"),
        F.round(distance, 6).alias("distance"),
        (F.coalesce(distance > most, F.lit(False)) | F.coalesce(change > most, F.lit(False))).alias("drifted"),
    )
