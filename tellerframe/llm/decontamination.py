"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A text's shingles are its runs of five lower-cased words; a text of one to four words is one shingle as a whole,
so it matches only a text of the same words.  Items are partitioned by size: those with 2^c to 2^(c+1) - 1 shingles
form class c, and are sketched by their 2^c smallest shingle hashes.  A document is a
candidate if it holds so many of them that at most (1 - containment) of the item can be missing.  That loses no
match: of an item's n shingles a match lacks floor((1 - containment) n) at most, hence as many of the sketch at most.
Candidates are verified on all shingles.

* Items without words match nothing.  Repeated item ids are one item with the shingles of all its rows.
* A document row is known by doc_id and text: equal rows are one.  Null ids are kept as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .words import let, unused, words_column

SHINGLE_WORDS = 5
CONTAINMENT = 75  # percent
BROADCAST_ROWS = 1_000_000  # of two numbers each


def shingles_column(text: str) -> Column:
    """Distinct shingle hashes of a text."""

    def hashes(words: Column) -> Column:
        n = F.size(words)
        runs = F.transform(F.sequence(F.lit(0), n - SHINGLE_WORDS), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE_WORDS)]))
        whole = F.array(F.xxhash64(F.array_join(words, " "), n))
        return F.when(n >= SHINGLE_WORDS, F.array_distinct(runs)).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return let(words_column(F.lower(F.col(text))), hashes)


def item_sketches(items: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """(item_id, n_shingles, shingles, size_class, sketch, n_needed) of items (item_id, text)."""
    sets = items.select("item_id", F.explode(shingles_column("text")).alias("s")).distinct()
    sets = sets.groupBy("item_id").agg(F.sort_array(F.collect_list("s")).alias("shingles")).withColumn("n_shingles", F.size("shingles"))
    sets = sets.withColumn("size_class", F.floor(F.log2("n_shingles")).cast("int"))
    k = F.pow(F.lit(2.0), F.col("size_class")).cast("int")
    may_miss = F.floor(F.col("n_shingles") * (100 - containment) / 100).cast("int")
    return sets.withColumn("sketch", F.slice("shingles", 1, k)).withColumn("n_needed", F.greatest(F.lit(1), F.size("sketch") - may_miss))


def contaminated(docs: DataFrame, items: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """(doc_id, text_key, item_id, n_item_shingles, n_shared, containment) of every document row and item of
    which it holds ``containment`` percent or more."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    sketches = materialize(item_sketches(items, containment), "sketches")
    probes = materialize(sketches.select("item_id", "n_needed", F.explode("sketch").alias("s")), "probes")
    # The items go round in blocks of a size that may be broadcast.
    blocks = max(1, -(-probes.count() // BROADCAST_ROWS))
    exploded = rows.select("doc_id", "text_key", F.explode(shingles_column("text")).alias("s"))
    hits = None
    for block in range(blocks):
        own = probes.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = exploded.join(F.broadcast(own), "s").groupBy("doc_id", "text_key", "item_id", "n_needed").agg(F.count_distinct("s").alias("n"))
        hits = found if hits is None else hits.unionByName(found)
    candidates = materialize(hits.where("n >= n_needed").select("doc_id", "text_key", "item_id"), "candidates")

    whole = sketches.select(F.col("item_id").alias("i"), F.col("shingles").alias("item"))
    pairs = candidates.join(whole, F.col("item_id").eqNullSafe(F.col("i")))
    pairs = pairs.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "item_id", "item")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    # equal rows are one among the few that are candidates, so that all others are sent once at most
    few = rows.join(pairs.select("d", "k").distinct(), same, "left_semi").distinct()
    both = few.join(pairs, same)
    shared = F.size(F.array_intersect(shingles_column("text"), F.col("item")))
    both = both.select("doc_id", "text_key", "item_id", F.size("item").cast("long").alias("n_item_shingles"), shared.cast("long").alias("n_shared"))
    return both.where(100 * F.col("n_shared") >= containment * F.col("n_item_shingles")).withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def clean(docs: DataFrame, items: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    d, k = unused(docs.columns, "d", "k")
    found = contaminated(docs, items, containment).select(F.col("doc_id").alias(d), F.col("text_key").alias(k)).distinct()
    same = docs["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(docs["text"].cast("string")) == F.col(k))
    return docs.join(found, same, "left_anti")
