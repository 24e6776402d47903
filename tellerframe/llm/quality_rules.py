"""Quality rules: counted properties of a text, and how much its n-grams resemble trusted text.

Unigrams and bigrams are hashed into BUCKETS buckets.  Two multinomials over the buckets are counted, one
over all documents and one over the trusted ones; the second is smoothed towards the first as if SMOOTHING
n-grams of raw text stood in it.  A document's ratio is the mean over its n-grams of the logarithm of trusted
share over raw share.

No document is judged by trusted counts it is part of.  Texts are dealt to FOLDS folds by their hash, so that
copies share one, and a text is judged by the trusted texts of the other folds.  The threshold is the ratio that
``keep_percent`` of the trusted documents past the base rules reach in that way, so about as many unseen texts of their
kind do; it is one number for all documents.

* The base rules come first: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of the words
  in three-word windows that occur twice or more, fail a text whatever its ratio.
* A text without words has no ratio (null) and fails as too short.
* Trusted ids may repeat or be missing from the documents; every row with such a doc_id is trusted.  Without any
  trusted text all ratios are 0 and the base rules alone decide.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerframe.sources.storage import materialize

from .words import let, words_column

BUCKETS = 1 << 16
SMOOTHING = 65_536.0
FOLDS = 4
KEEP_PERCENT = 99.0
STEP = 1e-4
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def grams_column(words: Column, buckets: int) -> Column:
    """Buckets of the unigrams and bigrams of an array of words."""
    bucket = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")
    pairs = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.concat(F.transform(words, lambda w: bucket(w)), F.transform(pairs, lambda w, i: bucket(w, F.get(words, i + 1))))


def _trusted_ids(trusted: DataFrame) -> DataFrame:
    return trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("is_trusted", F.lit(1))


def fold_column(text: Column, folds: int) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(folds)).cast("int")


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, folds: int = FOLDS) -> DataFrame:
    """A row for each bucket that occurs: its n-grams in all texts (r), and in the trusted texts of each fold (t0, t1, ...)."""
    # A fold is hashed from a whole text, so it is a column of its own below the n-grams, not part of each of them.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("fold", fold_column(F.col("text"), folds))
    # Trusted ids grow with the corpus: both sides are dealt by doc_id, and the texts need no sort.
    marked = texts.join(_trusted_ids(trusted).hint("shuffle_hash"), "doc_id", "left")
    grams = marked.select("fold", "is_trusted", F.explode(let(words_column("text"), lambda w: grams_column(w, buckets))).alias("bucket"))
    own = [F.count(F.when(F.col("fold") == f, F.col("is_trusted"))).alias(f"t{f}") for f in range(folds)]
    return grams.groupBy("bucket").agg(F.count("*").alias("r"), *own)


def bucket_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, folds: int = FOLDS) -> list[float]:
    """For every fold and, in it, every bucket: ln of its share in trusted texts of the other folds over its share in
    all texts.  A row for each bucket comes to the driver, whatever the size of the corpus."""
    raw, target = np.zeros(buckets), np.zeros((folds, buckets))
    for bucket, r, *own in gram_counts(docs, trusted, buckets, folds).collect():
        raw[bucket], target[:, bucket] = r, own
    share = (raw + 1) / (raw.sum() + buckets)
    others = target.sum(axis=0) - target
    smooth = (others + SMOOTHING * share) / (others.sum(axis=1, keepdims=True) + SMOOTHING)
    return np.log(smooth / share).ravel().tolist()


def repeat_words(words: Column) -> Column:
    """Words of an array that lie in a three-word window found twice or more in it.  The windows' hashes are
    sorted together with their places, for which each hash gives up as many low bits as they need."""
    shift = lambda name, value, bits: F.call_function(name, value, bits)
    bits = F.coalesce(F.ceil(F.log2(F.size(words) + F.lit(1.0))), F.lit(0)).cast("int")

    def packed(b: Column) -> Column:
        window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        places = F.sequence(F.lit(0), F.size(words) - 3)
        return F.sort_array(F.transform(places, lambda i: shift("shiftleft", window(i), b).bitwiseOR(i.cast("long"))))

    def repeated(p: Column, b: Column) -> Column:
        high = lambda v: shift("shiftright", v, b)
        same = lambda x, k: F.coalesce(high(x) == high(F.get(p, k)), F.lit(False))
        low = shift("shiftleft", F.lit(1).cast("long"), b) - 1
        return F.sort_array(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x.bitwiseAND(low)))

    def covered(places: Column) -> Column:
        three = F.lit(3).cast("long")
        steps = F.transform(places, lambda x, k: F.coalesce(F.least(F.get(places, k + 1) - x, three), three))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    counted = let(bits, lambda b: let(packed(b), lambda p: let(repeated(p, b), covered)))
    return F.when(F.size(words) >= 4, counted).otherwise(F.lit(0).cast("long"))


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """word_chars, n_symbols, n_dup_lines of a text that is not null; n_words, n_repeat_words of its words."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(words),
    }


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    folds: int = FOLDS,
    keep_percent: float = KEEP_PERCENT,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the base columns, base_failed, mean_ratio, kept."""
    numbers = ",".join(f"{r:.6f}" for r in bucket_ratios(docs, trusted, buckets, folds))
    table = F.split(F.lit(numbers), ",").cast("array<double>")  # a constant of the scoring expression

    def columns(words: Column, ratio: Column, first: Column) -> Column:
        at = lambda b: F.coalesce(F.get(ratio, first + b), F.lit(0.0))
        total = F.aggregate(grams_column(words, buckets), F.lit(0.0), lambda a, b: a + at(b))
        mean = F.when(F.size(words) > 0, total / (2 * F.size(words) - 1))
        base = base_columns(F.coalesce(F.col("text"), F.lit("")), words)
        return F.struct(*(c.alias(n) for n, c in base.items()), mean.alias("mean_ratio"))

    scored = lambda ratio, words: let(fold_column(F.col("text"), folds) * buckets, lambda first: columns(words, ratio, first))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", let(table, lambda ratio: let(words_column("text"), lambda words: scored(ratio, words))).alias("found")
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    # a row of numbers for each text, so that the threshold does not read the texts again
    found = materialize(found.select("doc_id", "found.*").withColumn("base_failed", failed), "quality-numbers")
    enough = F.col("mean_ratio") >= threshold(found.where("NOT base_failed"), trusted, keep_percent)
    return found.withColumn("kept", ~F.col("base_failed") & F.coalesce(enough, F.lit(False)))


def threshold(found: DataFrame, trusted: DataFrame, keep_percent: float) -> float:
    """The ratio, down to a multiple of STEP, that ``keep_percent`` of the trusted rows reach; without any, none is too low.

    Equal multiples are counted, and the counts come to the driver: the logarithms are bounded, so these are some hundred
    thousand at most, whatever the corpus."""
    step = F.floor(F.col("mean_ratio") / F.lit(STEP)).alias("step")
    rows = found.join(_trusted_ids(trusted), "doc_id", "left_semi").groupBy(step).count().where("step IS NOT NULL").collect()
    wanted, reached = keep_percent / 100 * sum(r["count"] for r in rows), 0
    for r in sorted(rows, key=lambda r: -r["step"]):
        reached += r["count"]
        if reached >= wanted:
            return r["step"] * STEP
    return -math.inf
