"""Mixing sources to target weights along a curriculum.

Sources, ordered by code point with null last, have the weights WEIGHTS in turn and share as many words as all
documents have; no source is taken more than REPEATS times, and what it would have had beyond is shared again
by weight.  Each source has a schedule too, a piecewise linear weight over training time.  Its integral is the
source's cumulative demand of words; a document that stands at a certain word of its source is trained on when
the demand reaches that word, which the inverted integral tells.  Documents are then sorted by that position.

Within a source documents stand in the order of the MD5 of their doc_id, and after the last come the first again.

* A document's words count as soon as its source's target reaches them: the last one may be taken in part.
* Null texts have size 0.  A null doc_id stands before every other.  Rows with the same doc_id and size may change
  places, which changes no figure.  A source without words has a target of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .words import unused, words_column

WEIGHTS = (5, 2, 1)
REPEATS = 3
Knots = Sequence[tuple[float, float]]
# The heavy sources come early, the light ones late.
SCHEDULES: tuple[Knots, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
ROWS_PER_GROUP = 10_000


def size_column(text: str = "text") -> Column:
    return F.size(words_column(text)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, turn, source_size, target, n_rows) of (source, size).  A source is capped if, once all with fewer
    words for their weight are, its share of the rest is above ``repeats`` times its size."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)  # a row for each source
    sums = sums.withColumn("turn", turn)
    sums = sums.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("turn") + 1).cast("long"))
    order = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everyone = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    taken = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * repeats
    weight_left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sums = sums.withColumn("level", (F.sum("source_size").over(everyone) - taken) / weight_left)
    free = F.when(F.col("level") * F.col("weight") <= repeats * F.col("source_size"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return sums.withColumn("level", level).select(
        "source", "turn", "source_size", "n_rows",
        F.least(F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf"))), (repeats * F.col("source_size")).cast("double")).alias("target"),
    )


def when_demanded(share: Column, knots: Knots) -> Column:
    """Training time from 0 to 1 at which the integral of the schedule reaches this share of its whole."""
    total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    done, result = 0.0, F.lit(float(knots[-1][0]))
    pieces = []
    for (t, v), (end, w) in zip(knots, knots[1:]):
        area, slope = (end - t) * (v + w) / 2, (w - v) / (end - t)
        rest = share * total - done
        speed = F.lit(float(v)) + F.sqrt(F.greatest(F.lit(float(v * v)) + 2 * slope * rest, F.lit(0.0)))
        time = F.lit(t) + F.coalesce(F.try_divide(2 * rest, speed), F.lit(0.0))  # a schedule may begin at 0
        pieces.append((done + area, time))
        done += area
    for end, time in reversed(pieces):
        result = F.when(share * total < end, time).otherwise(result)
    return result


def curriculum(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    schedules: Sequence[Knots] = SCHEDULES,
) -> DataFrame:
    """``rows`` (doc_id, source, size and any other columns), sorted by training position, with source_size, target,
    taken (words over all copies) and copies (position and words of each copy that is taken)."""
    named = {c.lower() for c in rows.columns}
    if clash := named & {"source_size", "target", "taken", "copies"}:
        rows = rows.drop(*clash)
    # Numbered rows are written, so that every later reading meets the same numbers.
    row, key = unused(rows.columns, "row", "key")
    rows = materialize(rows.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    sizes = rows.select(F.col(row).alias("_row"), "doc_id", "source", "size")
    targets = materialize(source_targets(sizes, weights, repeats), "mix-targets")
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]

    # Groups of a source are ranges of the MD5, as many as keep them near ROWS_PER_GROUP rows.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n_rows") / ROWS_PER_GROUP))).cast("int")
    t = targets.withColumnRenamed("source", "_source").withColumn("_digits", digits)
    placed = sizes.join(t, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = placed.withColumn("_group", F.substring(F.col("_key"), F.lit(1), F.col("_digits")))
    groups = placed.groupBy("_source", "_group").agg(F.sum("size").alias("_words"))
    earlier = W.partitionBy("_source").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    groups = groups.select(F.col("_source").alias("_s"), F.col("_group").alias("_g"), F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
    placed = placed.join(groups, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_group") == F.col("_g")))
    inside = W.partitionBy("_source", "_group").orderBy("_key", "doc_id", "size", "_row").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("_start", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))

    def copy(k: int) -> Column:
        start = F.col("_start") + k * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.floor("target") - start))
        share = F.try_divide(start, F.col("target"))
        time = F.lit(None).cast("double")
        for turn in range(len(weights)):
            time = F.when(F.col("turn") == turn, when_demanded(share, schedules[turn % len(schedules)])).otherwise(time)
        return F.struct((time * total).alias("position"), words.alias("words"))

    copies = F.filter(F.array(*[copy(k) for k in range(repeats)]), lambda c: c["words"] > 0)
    mixed = placed.withColumn("copies", copies).select(
        F.col("_row").alias(row), "source_size", "target", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"),
        "copies", F.col("_key").alias(key),
    )
    first = F.get("copies", F.lit(0))["position"]
    return rows.join(mixed, row).orderBy(first.asc_nulls_last(), key, row).drop(row, key)
