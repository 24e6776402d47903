"""Stupid-backoff scores of every document under n-gram counts of the whole corpus.

Counts of all runs of one to ``order`` words are held by range of their hash.  Each block of documents is
joined to the counts of its own n-grams, range by range, and sums its documents' logarithms:

    S(w | context) = count(context w) / count(context)        if the n-gram was counted min_count times or more
                   = backoff * S(w | context without its first word)    otherwise
    S(w)           = count(w) / words of the corpus

The first words of a document have as much context as there is.  A document's log_score is the sum over its
words, mean_log_score that by word; null, empty and blank texts have no words, a sum of 0 and no mean.
Repeated rows and null ids count like any other row.

N-grams are known by 50 bits of their hash (more with larger blocks): of a corpus of D distinct n-grams, one in
2^50 / D shares its count with another, 6 in a million at 30 GB.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from . import blocks as B
from .words import Words, mix, read_words, window_hashes, windows

BLOCK_BYTES = 4 << 20  # three kinds of n-grams need more memory than one
_PARTIAL = "doc_id bigint, n_words bigint, n_single bigint, partial double"


def stupid_backoff(docs: DataFrame, order: int = 3, backoff: float = 0.4, min_count: int = 2) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, log_score, mean_log_score."""
    dealt = B.deal(docs, BLOCK_BYTES)
    n_ranges = dealt.n_ranges
    # As many bits as keep the differences between a block's sorted keys below four bytes.
    bits = min(64, 29 + (dealt.block_bytes // 4).bit_length())

    def first(block: int, own: pa.Table) -> list[tuple]:
        grams = _grams(read_words(own.column("text")), order, bits)
        keys, counts = np.unique(np.concatenate([keys for _, keys in grams]), return_counts=True)
        return B.questions(block, keys, n_ranges, counts.astype(np.int64))

    def scored(block: int, own: pa.Table, replies: pa.Table) -> pa.Table:
        found = read_words(own.column("text"))
        grams = _grams(found, order, bits)
        _, key = np.unique(np.concatenate([keys for _, keys in grams]), return_inverse=True)
        counts = B.answers(replies, np.int64)[key]
        partial, single = _sums(found, [at for at, _ in grams], counts, backoff, min_count)
        rows = [np.bincount(found.row, weights=v, minlength=own.num_rows) for v in (single, partial)]
        return pa.table(
            [own.column("doc_id"), pa.array(found.counts, pa.int64()), pa.array(rows[0].astype(np.int64)), pa.array(rows[1])],
            names=["doc_id", "n_words", "n_single", "partial"],
        )

    told = B.answer(B.ask(dealt, first), _totals)
    sums = materialize(B.tell(dealt, told, scored, _PARTIAL), "lm-sums")
    corpus = sums.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    score = F.col("partial") - F.col("n_single") * F.lit(math.log(max(1, corpus)))
    return sums.select("doc_id", "n_words", score.alias("log_score"), F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"))


def _grams(found: Words, order: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first words, keys) of the runs of 1 .. order words."""
    result = []
    for n in range(1, order + 1):
        at = windows(found, n)
        result.append((at, B.coarse(mix(window_hashes(found, n, at) + np.uint64(n)), bits)))
    return result


def _totals(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    _, key = np.unique(keys, return_inverse=True)
    totals = np.zeros(key.max() + 1 if len(key) else 0, np.int64)
    np.add.at(totals, key, counts)
    return totals[key]


def _sums(found: Words, starts: list[np.ndarray], counts: np.ndarray, backoff: float, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word its logarithm, without the corpus size, and whether it came down to the single word."""
    total = len(found.hash)
    place = np.arange(total) - np.repeat(found.first, found.counts)
    by_end, done = [], 0
    for n, at in enumerate(starts, 1):
        ends = np.zeros(total)
        ends[at + n - 1] = counts[done : done + len(at)]
        by_end.append(ends)
        done += len(at)
    value, single = np.zeros(total), np.ones(total)
    with np.errstate(divide="ignore"):
        value += np.log(by_end[0])
        for n in range(2, len(starts) + 1):
            had_context = place >= n - 1
            seen = had_context & (by_end[n - 1] >= min_count)
            context = np.empty(total)
            context[:1] = 1
            context[1:] = by_end[n - 2][:-1]
            value[had_context & ~seen] += math.log(backoff)
            value[seen] = np.log(by_end[n - 1][seen]) - np.log(context[seen])
            single[seen] = 0
    return value, single
