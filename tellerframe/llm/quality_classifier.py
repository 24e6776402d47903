"""Quality classifier: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of other signs; a document's features are its unigrams and
bigrams, hashed into DIMENSIONS buckets, each worth 1 / sqrt(number of n-grams).

Fitting takes MAX_ROWS labelled documents at most, those with the smallest hash of their doc_id, in shards of
SHARD_ROWS rows: each shard is fitted where it lies, and the shards' weights are averaged.  Scoring is one
pass over all whole texts with sparse dot products.

* Labels are taken by doc_id; of repeated labels the larger counts.  Labels without doc_id, without a value or
  without a document teach nothing.  Without any label every score is 0.5.
* A null or blank text has no features: its score is that of the bias, learned from all labelled rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .shipping import ship
from .words import SPACES, buffers, pieces, read_words, window_hashes, windows

DIMENSIONS = 1 << 18
MAX_ROWS = 20_000
SHARD_ROWS = 4_000
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1e-3, 1e-4, 3

_KINDS = np.full(256, 2, np.uint8)  # signs
_KINDS[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1
_KINDS[[ord(c) for c in SPACES]] = 0


def features(texts) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all texts' n-grams, text by text; n-grams of each text)."""
    found = read_words(texts, kinds=_KINDS)
    one, two = windows(found, 1), windows(found, 2)
    rows = np.concatenate([found.row[one], found.row[two]])
    keys = np.concatenate([window_hashes(found, 1, one), window_hashes(found, 2, two)])
    order = np.argsort(rows, kind="stable")
    counts = np.bincount(rows, minlength=len(found.counts))
    return (keys[order] >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64), counts


def fit_shard(texts, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes, one update for each document."""
    documents = []
    for a, b in pieces(buffers(texts)[1]):
        buckets, counts = features(texts.slice(a, b - a))
        for end, n in zip(np.cumsum(counts), counts):
            own, times = np.unique(buckets[end - n : end], return_counts=True)
            documents.append((own, times / np.sqrt(max(1, n))))
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    bias_z = bias_n = 0.0
    for _ in range(EPOCHS):
        for (own, x), y in zip(documents, labels):
            w, b = _weights(z[own], n[own], L1), float(_weights(np.array([bias_z]), np.array([bias_n]), 0.0)[0])
            miss = 1 / (1 + np.exp(-np.clip(w @ x + b, -35, 35))) - y
            for_own, g = _learn(n[own], miss * x), miss * x
            z[own] += g - for_own * w
            n[own] += g * g
            bias_z += miss - float(_learn(np.array([bias_n]), np.array([miss]))[0]) * b
            bias_n += miss * miss
    return _weights(z, n, L1), float(_weights(np.array([bias_z]), np.array([bias_n]), 0.0)[0])


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _learn(n: np.ndarray, g: np.ndarray) -> np.ndarray:
    return (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA


def fit(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """(weights, bias) learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, ``label`` 0 or 1)."""
    ship(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("double").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    shards = max(1, -(-sample.count() // SHARD_ROWS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(sample), "doc_id")  # of max_rows rows
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int"))

    def fitted(own: pa.Table) -> pa.Table:
        own = own.take(pa.array(np.argsort(_scattered(own.column("doc_id").to_numpy()), kind="stable")))
        weights, bias = fit_shard(own.column("text"), own.column("label").to_numpy())
        return pa.table({"shard": own.column("shard").slice(0, 1), "weights": [weights.astype(np.float32).tobytes()], "bias": [bias], "n": [own.num_rows]})

    models = rows.groupBy("shard").applyInArrow(fitted, "shard int, weights binary, bias double, n bigint").orderBy("shard").collect()
    if not models:
        return np.zeros(DIMENSIONS, np.float32), 0.0
    sizes = np.array([m["n"] for m in models], float)
    weights = np.average([np.frombuffer(m["weights"], np.float32) for m in models], axis=0, weights=sizes)
    return weights.astype(np.float32), float(np.average([m["bias"] for m in models], weights=sizes))


def _scattered(ids: np.ndarray) -> np.ndarray:
    return ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def scores(docs: DataFrame, model: tuple[np.ndarray, float], column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 beside its columns."""
    ship(docs.sparkSession)
    weights, bias = model
    names = docs.columns

    def scored(batches):
        for batch in batches:
            texts = batch.column(names.index("text")).cast(pa.large_string()).fill_null("")
            values = np.full(batch.num_rows, bias)
            # about 1 MB of text at a time, whatever the size of a batch
            for a, b in pieces(buffers(texts)[1]):
                buckets, counts = features(texts.slice(a, b - a))
                total = np.zeros(len(buckets) + 1)
                np.cumsum(weights[buckets], out=total[1:], dtype=np.float64)
                ends = np.cumsum(counts)
                values[a:b] += (total[ends] - total[ends - counts]) / np.sqrt(np.maximum(counts, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(values, -35, 35))))], names=[*names, column])

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(scored, schema)


def fold(share: int) -> Column:
    """crc32 of the doc_id as text, modulo ``share``; null without doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(share))


def predicted_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learned from the two folds that are not held out."""
    model = fit(docs, labels.where(fold(3) != 1), "quality")
    rows = docs.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return scores(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
