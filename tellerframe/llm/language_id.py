"""Language identification with error-correcting output codes.

Every language has a codeword of bits; one logistic regression on hashed byte trigrams predicts each bit.  A
text's language is that whose codeword loses least over all bits, ln(1 + exp(-margin)) weighted by how well each
bit's classifier separates the sample; a text is ambiguous where the two best codewords lose nearly the same.

Fitting takes ROWS_PER_LANGUAGE whole documents of each language at most, those with the smallest hash of their
doc_id; each bit is fitted by a task of its own.  Scoring is one pass over all whole texts.

* Texts are lower-cased.  A null text and one without any letter are ``und``, with score 0.
* Rows without doc_id or lang teach nothing.  With one language every text with a letter is of that language;
  with none every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .quality_classifier import fold
from .shipping import ship
from .words import buffers, pieces, unused

DIMENSIONS = 1 << 13
ROWS_PER_LANGUAGE = 300
ROUNDS, RATE, DECAY = 80, 0.5, 1e-3
AMBIGUOUS = 0.1  # of the best codeword's share over the second's


def codewords(n: int) -> np.ndarray:
    """+1 and -1, a row for each of n classes: every split of the classes in two for up to five, else the one
    of 200 seeded random codes whose closest rows differ most."""
    if n <= 5:
        splits = [[1 if c == 0 else (1 if s >> (c - 1) & 1 else -1) for c in range(n)] for s in range(2 ** max(0, n - 1) - 1)]
        return np.array(splits or [[1] * n], float).T
    bits = 10 * (n - 1).bit_length()
    draws = np.random.default_rng(n)
    codes = [draws.choice([-1.0, 1.0], (n, bits)) for _ in range(200)]
    return max(codes, key=lambda c: -np.max(c @ c.T - 2 * bits * np.eye(n)))


def trigrams(texts):
    """(buckets of the byte trigrams of some texts, trigrams of each) for each range of about 1 MB."""
    data, offsets = buffers(texts)
    for a, b in pieces(offsets):
        part, own = data[offsets[a] : offsets[b]].astype(np.uint32), offsets[a : b + 1] - offsets[a]
        n = np.maximum(np.diff(own) - 2, 0)
        at = np.arange(n.sum()) + np.repeat(own[:-1] - (np.cumsum(n) - n), n)
        mixed = (part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]) * np.uint32(2654435761) if len(part) > 2 else part[:0]
        yield a, b, (mixed >> np.uint32(32 - DIMENSIONS.bit_length() + 1))[at], n


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, counts[i] of them at a time."""
    result = np.zeros((len(counts), values.shape[1]))
    some = counts > 0
    if some.any():
        result[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.float64)
    return result


def _frequencies(own: pa.Table) -> np.ndarray:
    x = np.zeros((own.num_rows, DIMENSIONS), np.float32)
    for i, data in enumerate(own.column("trigrams").to_pylist()):
        bucket, times = np.frombuffer(data, np.uint32).reshape(2, -1)
        x[i, bucket] = times / max(1, times.sum())
    return x


def _fit_bit(own: pa.Table, code: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights of the trigram frequencies, bias, and the bit's weight in decoding."""
    x = _frequencies(own)
    spread = x.std(axis=0)
    scale = np.where(spread > 0, 1 / np.maximum(spread, 1e-9), 0).astype(np.float32)
    centre = x.mean(axis=0)
    x = (x - centre) * scale / np.float32(np.sqrt(DIMENSIONS))
    y = code[own.column("class").to_numpy()].astype(np.float32)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(DIMENSIONS, np.float32), 0.0
    for _ in range(ROUNDS):
        pull = y * share / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        w += RATE * 10 * (pull @ x) - DECAY * w
        b += RATE * float(pull.sum())
    weight = float(np.sum(share * (y * (x @ w + b) > 0)))
    w = w * scale / np.float32(np.sqrt(DIMENSIONS))
    return w, b - float(centre @ w), weight


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(languages, weights by trigram and bit, biases, bit weights) from ``docs`` (doc_id, text, lang)."""
    ship(docs.sparkSession)
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    first = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows_per_language)
    chosen = chosen.select("doc_id", "lang").distinct()
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    codes = codewords(len(languages)) if languages else np.zeros((0, 0))
    if len(languages) < 2:
        return languages, np.zeros((DIMENSIONS, 1), np.float32), np.zeros(1), np.ones(1)
    # rows_per_language rows of each language
    sample = known.select("doc_id", "lang", F.concat(F.lit(" "), F.lower(F.coalesce("text", F.lit(""))), F.lit(" ")).alias("text"))
    sample = sample.join(F.broadcast(chosen), ["doc_id", "lang"])

    def counted(batches):
        for batch in batches:
            packed = []
            for _, _, buckets, n in trigrams(batch.column("text")):
                for end, size in zip(np.cumsum(n), n):
                    packed.append(np.stack(np.unique(buckets[end - size : end], return_counts=True)).astype(np.uint32).tobytes())
            classes = pa.array([languages.index(v) for v in batch.column("lang").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), classes, pa.array(packed, pa.binary())], names=["doc_id", "class", "trigrams"])

    bits = F.explode(F.array(*[F.lit(b) for b in range(codes.shape[1])])).alias("bit")
    rows = sample.mapInArrow(counted, "doc_id bigint, class int, trigrams binary").select(bits, "doc_id", "class", "trigrams")

    def fitted(own: pa.Table) -> pa.Table:
        bit = own.column("bit")[0].as_py()
        own = own.sort_by([("doc_id", "ascending"), ("class", "ascending"), ("trigrams", "ascending")])
        w, b, weight = _fit_bit(own, codes[:, bit])
        return pa.table({"bit": pa.array([bit], pa.int32()), "weights": [w.astype(np.float32).tobytes()], "bias": [b], "weight": [weight]})

    models = rows.groupBy("bit").applyInArrow(fitted, "bit int, weights binary, bias double, weight double").orderBy("bit").collect()
    weights = np.stack([np.frombuffer(m["weights"], np.float32) for m in models], axis=1)
    return languages, np.ascontiguousarray(weights), np.array([m["bias"] for m in models]), np.array([m["weight"] for m in models])


def identified(docs: DataFrame, model) -> DataFrame:
    """``docs`` (any columns and text) with lang_pred, score and ambiguous."""
    ship(docs.sparkSession)
    languages, weights, biases, bit_weights = model
    codes = codewords(len(languages)) if languages else np.zeros((0, 0))
    lower, letter = unused(docs.columns, "lower", "letter")

    def predicted(batches):
        for batch in batches:
            share = np.zeros((batch.num_rows, max(1, len(languages))))
            if len(languages) > 1:
                for a, b, buckets, n in trigrams(batch.column(names.index(lower))):
                    margins = _sums(weights[buckets], n) / np.maximum(n, 1)[:, None] + biases
                    loss = np.einsum("dbl,b->dl", np.logaddexp(0, -margins[:, :, None] * codes.T[None]), bit_weights)
                    odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
                    share[a:b] = odds / odds.sum(axis=1, keepdims=True)
            else:
                share[:] = 1.0
            letters = batch.column(names.index(letter)).to_numpy(zero_copy_only=False).astype(bool) & bool(languages)
            best = share.argmax(axis=1)
            ordered = np.sort(share, axis=1)
            close = (ordered[:, -1] - ordered[:, -2] < AMBIGUOUS) if share.shape[1] > 1 else np.zeros(len(best), bool)
            found = [languages[i] if ok else "und" for i, ok in zip(best, letters)]
            kept = [c for c, name in zip(batch.columns, names) if name not in (lower, letter)]
            score = np.where(letters, share.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string()), pa.array(score), pa.array(close & letters)], names=out.fieldNames())

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]
    out = StructType([*docs.schema.fields, *added])
    rows = docs.select("*", F.concat(F.lit(" "), F.lower(text), F.lit(" ")).alias(lower), text.rlike(r"\p{L}").alias(letter))
    names = rows.columns
    return rows.mapInArrow(predicted, out)


def predicted_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row; remainder 2 of four is not learned from."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(fold(4) != 2))
    asked = docs.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return identified(asked, model).drop("text")
