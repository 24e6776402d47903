"""Exact medians by counting, not by collecting.

Spark's exact ``percentile`` holds every distinct value of a group in one
buffer.  Here equal values are merged first, in one partial aggregation over
the source.  On that table of distinct values the middle is then narrowed down
16 bits at a time: each round counts rows per 16-bit slice of the range still
possible, a mergeable aggregate with at most 65,536 rows per group, and keeps
the slice that holds the middle rank.  No task ever sees a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerframe.sources.storage import materialize

_STEP = 16


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), scale: int | None = None) -> DataFrame:
    """Columns of ``by`` plus ``median`` and ``n`` over the non-null values.

    ``value`` is a decimal or an integer, which say themselves how many decimals
    they have; other types need ``scale``, to which they are rounded.  The mean
    of the two middle values is taken for even counts.  Null groups are kept.
    """
    by = list(by)
    kind = df.schema[value].dataType
    if isinstance(kind, T.DecimalType):
        scale = kind.scale
    elif isinstance(kind, T.IntegralType):
        scale = 0
    elif scale is None:
        raise TypeError(f"the median of a {kind.simpleString()} needs a scale")
    unscaled = (F.col(value).cast(f"decimal(20,{scale})") * 10**scale).cast("long")
    values = df.select(*by, unscaled.alias("_v")).filter(F.col("_v").isNotNull())
    data = materialize(values.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_w")), "median-values")

    bounds = data.agg(F.min("_v"), F.max("_v")).first()
    low, high = bounds
    if low is None:
        return data.groupBy(*by).agg(F.lit(None).cast(f"decimal(22,{scale + 1})").alias("median"), F.sum("_w").alias("n"))
    data = data.select(*by, (F.col("_v") - F.lit(low)).alias("_v"), "_w")
    shift = -(-(high - low).bit_length() // _STEP) * _STEP

    sizes = data.groupBy(*by).agg(F.sum("_w").alias("n"))
    middle = F.array_distinct(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2")))
    targets = materialize(
        sizes.select(*by, "n", F.posexplode(middle).alias("_side", "_rank")).withColumn("_prefix", F.lit(0).cast("long")),
        "median-targets",
    )
    while shift > 0:
        shift -= _STEP
        targets = materialize(_narrow(data, targets, by, shift), "median-targets")

    divisor = Decimal(2 * 10**scale)
    total = F.sum(F.col("_prefix") + F.lit(low)) * F.when(F.count(F.lit(1)) == 1, 2).otherwise(1)
    return (
        targets.groupBy(*by, "n")
        .agg(total.alias("_twice"))
        .select(*by, F.round(F.col("_twice") / F.lit(divisor), scale + 1).cast(f"decimal(22,{scale + 1})").alias("median"), "n")
    )


def _narrow(data: DataFrame, targets: DataFrame, by: list[str], shift: int) -> DataFrame:
    """Replace each target's prefix by the 16-bit-longer one that holds its rank."""
    prefixes = targets.select(*by, "_prefix").distinct()
    # a shift by 64 would be a shift by 0
    prefix = F.lit(0).cast("long") if shift + _STEP >= 64 else F.shiftright("_v", shift + _STEP)
    values = data.select(*by, prefix.alias("_prefix"), F.shiftright("_v", shift).alias("_slice"), "_w")
    on = ["_prefix", *by]
    counts = (
        values.alias("v")
        .join(prefixes.alias("p"), _same(on, "v", "p"), "left_semi")
        .groupBy(*on, "_slice")
        .agg(F.sum("_w").alias("_c"))
    )
    group = Window.partitionBy(*[f"t.{c}" for c in by], "_side").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.alias("c").join(targets.alias("t"), _same(on, "c", "t")).withColumn("_upto", F.sum("_c").over(group))
    before = F.col("_upto") - F.col("_c")
    return ranked.filter((F.col("_upto") > F.col("_rank")) & (before <= F.col("_rank"))).select(
        *[F.col(f"t.{c}") for c in by],
        "n",
        "_side",
        (F.col("_rank") - before).alias("_rank"),
        F.col("_slice").alias("_prefix"),
    )
