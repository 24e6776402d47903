"""Connected components by alternating large and small stars, on edges kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import delete_path, fresh_path


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of the edges (a, b), which are numbers: the component is its
    smallest vertex.  Null ends and loops are ignored; repeated edges are one edge.  Each round is
    written, so a lost executor costs one round at most; the round before it is then deleted.  Rounds go on until
    nothing changes."""
    spark = edges.sparkSession
    ordered = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state, path = _written(ordered.distinct())
    before = None
    while (now := _print(state)) != before:
        before, done = now, path
        state, path = _written(_small_star(_large_star(state)))
        delete_path(spark, done)
    return state.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("component")).unionByName(
        state.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )


def _written(state: DataFrame) -> tuple[DataFrame, str]:
    path = fresh_path(state.sparkSession, "edges")
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path), path


def _print(state: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(state.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 20))).first())


def _large_star(state: DataFrame) -> DataFrame:
    """Larger neighbours of each vertex go to its smallest neighbour or itself."""
    both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(state: DataFrame) -> DataFrame:
    """Each vertex and its smaller neighbours go to the smallest of them."""
    least = state.groupBy("u").agg(F.min("v").alias("m"))
    joined = state.join(least, "u")
    return (
        joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
