"""Equal-width histograms of clipped values, as one mergeable count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerframe.functions.ratios import ratio


def clipped_histogram(df: DataFrame, value: str, cap: int, bins: int, scale: int = 2) -> DataFrame:
    """``bin``, ``lower_edge`` and ``n`` for all bins between the least and the
    greatest clipped value; the last bin is closed, nulls are left out.

    Bin numbers come from integer arithmetic on unscaled values, so no value
    slips over an edge by floating-point error.  All-equal values fall into
    the middle bin.
    """
    # least() skips nulls, so they have to go before the clipping
    clipped = F.least(F.col(value), F.lit(cap)).cast(f"decimal(20,{scale})")
    data = df.filter(F.col(value).isNotNull()).select((clipped * 10**scale).cast("long").alias("_v"))
    bounds = data.agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    low = bounds.select("_low").scalar()
    high = bounds.select("_high").scalar()

    placed = data.withColumns({"_low": low, "_high": high}).select(
        F.when(F.col("_low") == F.col("_high"), F.lit(bins // 2))
        .otherwise(
            F.least(
                F.expr(f"((_v - _low) * {bins}L) div (_high - _low)"),
                F.lit(bins - 1),
            )
        )
        .cast("int")
        .alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = F.col("_low") * bins + (F.col("_high") - F.col("_low")) * F.col("bin")
    return (
        frame.join(counts, "bin", "left")
        .withColumns({"_low": low, "_high": high})
        .select("bin", ratio(edge, F.lit(bins * 10**scale), scale).alias("lower_edge"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    )
