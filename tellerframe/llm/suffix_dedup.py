"""Passages that occur more than once, found at minimisers and decided for whole runs of min_words words.

Minimisers are the runs of GRAM words with the smallest hash among WINDOW neighbouring ones, so that equal
passages have equal minimisers.  A run of min_words words is a candidate if the HEAD words at its first and at its
last minimiser both occur again somewhere; only candidates are asked for in the whole corpus.  The holder of a
run's hash knows every block that has it and names the smallest place, so no passage depends on which neighbour
it happens to meet: two places that share min_words words are found whatever else shares a part of them.

A block asks for each of its runs once, and pairs the places of a run that it holds more than once with the one
before.  A passage that a third of all documents share is therefore asked for once for each block, and the pairs
stay as many as the repeated runs.  Pairs on one diagonal become chains, which are extended left and right, word
by word, to the passage that both places share.

* Rows that share a doc_id are documents of their own; rows equal in doc_id and text too.
* A null doc_id is a document without a number.  Null, empty and short texts have no passages.
* Runs are decided by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from . import blocks as B
from .words import Words, read_words, window_hashes, windows

GRAM, WINDOW, HEAD = 8, 24, 24
REACH = WINDOW + HEAD  # words looked at beyond each end of a chain
_BLOCK_BITS = 36  # a place is a word of a block: block << _BLOCK_BITS | word
_CHAINS = "block int, first bigint, last bigint, mate_block int, mate_first bigint, mate_last bigint"
_ENDS = "chain bigint, side int, text bigint, doc_id bigint, place bigint, n bigint, left_words binary, right_words binary"
_PAIRS = "doc_id bigint, start bigint, other_doc_id bigint, other_start bigint, n_words bigint, within boolean"


def minimisers(found: Words) -> np.ndarray:
    """The minimiser of the WINDOW runs of GRAM words that begin at each word, where a text has as many."""
    values = np.full(len(found.hash), np.iinfo(np.uint64).max)
    at = windows(found, GRAM)
    values[at] = window_hashes(found, GRAM, at)
    # The least of each run of WINDOW values by doubling, and where its leftmost one stands.
    best, place, have = values, np.arange(len(values)), 1
    while have < WINDOW:
        step = min(have, WINDOW - have)
        size = max(0, len(best) - step)
        other = best[step:] < best[:size]
        best, place = np.where(other, best[step:], best[:size]), np.where(other, place[step:], place[:size])
        have += step
    return place


def _heads(found: Words, place: np.ndarray) -> np.ndarray:
    """Minimisers that have HEAD words."""
    chosen = np.zeros(len(found.hash), bool)
    chosen[place[windows(found, GRAM + WINDOW - 1)]] = True
    return np.flatnonzero(chosen & (found.left() >= HEAD))


def repeated_passages(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """Passages (doc_id, start, n_words), counted in words from 0, that occur again at (other_doc_id, other_start);
    ``within`` tells whether both places are in one document.  Every place of a repeated run of min_words words lies
    in a passage of its own document: that of the larger doc_id, or the later one of a document, names the place
    it is paired with, and that place's document gets the passage once, with one of those that name it.  A passage
    is extended to the first differing word, or REACH words beyond the outermost run that has this partner; where
    the partner changes within a passage, its parts are passages of their own."""
    if min_words < WINDOW + HEAD - 1:
        raise ValueError(f"passages of {WINDOW + HEAD - 1} words are the shortest that always hold a minimiser's head")
    dealt = B.deal(docs)
    n_ranges, bits = dealt.n_ranges, dealt.coarse_bits

    def heads(block: int, own: pa.Table) -> list[tuple]:
        found = read_words(own.column("text"))
        at = _heads(found, minimisers(found))
        return B.questions(block, np.unique(B.coarse(window_hashes(found, HEAD, at), bits)), n_ranges)

    def runs(block: int, own: pa.Table, replies: pa.Table) -> pa.Table:
        found = read_words(own.column("text"))
        at = _candidates(found, B.answers(replies), bits, min_words)
        if not len(at):
            return B.asked([])
        keys, first = np.unique(window_hashes(found, min_words, at), return_index=True)
        return B.asked([*B.questions(block, keys, n_ranges, (block << _BLOCK_BITS) + at[first]), B.carry(block, at)])

    def chains(block: int, own: pa.Table, replies: pa.Table) -> pa.Table:
        return _chains(block, own, replies, min_words)

    told = B.answer(B.ask(dealt, heads), _elsewhere)
    places = B.answer(B.tell(dealt, told, runs, B.ASKED), _smallest)
    pairs = materialize(B.tell(dealt, places, chains, _CHAINS), "chains").withColumn("chain", F.xxhash64("block", "first", "mate_block", "mate_first"))
    both = [
        pairs.select(F.col(f"{p}block").alias("block"), "chain", F.lit(s).alias("side"), F.col(f"{p}first").alias("first"), F.col(f"{p}last").alias("last"))
        for s, p in enumerate(("", "mate_"))
    ]
    ends = B.tell(dealt, both[0].unionByName(both[1]), lambda block, own, asked: _ends(block, own, asked, min_words), _ENDS)
    one, two = (
        ends.where(F.col("side") == s).select("chain", F.struct("doc_id", "place", "text").alias(f"at_{s}"), "n", *(F.col(c).alias(f"{c}_{s}") for c in ("left_words", "right_words")))
        for s in (0, 1)
    )
    # The place of the larger doc_id, or the later one of a document, comes first.
    extended = one.join(two.drop("n"), "chain").withColumns({"x": F.greatest("at_0", "at_1"), "y": F.least("at_0", "at_1")})
    within = (F.col("x.text") == F.col("y.text")).alias("within")
    sides = (f"{c}_words_{s}" for c in ("left", "right") for s in (0, 1))
    extended = extended.select("x.doc_id", "x.place", F.col("y.doc_id").alias("mate_id"), F.col("y.place").alias("mate_place"), "n", within, *sides)
    found = extended.mapInArrow(lambda batches: (_extended(b, min_words) for b in batches), _PAIRS)
    # Each pair from both sides.  A place that very many others name is merged before the exchange.
    def side(doc: str, start: str, other: str, other_start: str):
        return F.struct(F.col(doc).alias("doc_id"), F.col(start).alias("start"), "n_words", "within", F.struct(F.col(other).alias("doc_id"), F.col(other_start).alias("start")).alias("other"))

    places = ("doc_id", "start", "other_doc_id", "other_start")
    sided = found.select(F.explode(F.array(side(*places), side(*places[2:], *places[:2]))).alias("p")).select("p.*")
    passages = sided.groupBy("doc_id", "start", "n_words", "within").agg(F.min("other").alias("other"))
    return passages.select("doc_id", "start", F.col("other.doc_id").alias("other_doc_id"), F.col("other.start").alias("other_start"), "n_words", "within")


def _elsewhere(keys: np.ndarray, _: np.ndarray) -> np.ndarray:
    _, key, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return (counts[key] > 1).astype(np.uint8)


def _smallest(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The smallest place of each key, plus 1; 0 where it is the asking block's own."""
    order = np.lexsort((places, keys))
    ordered, own = keys[order], places[order]
    starts = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    least = own[np.flatnonzero(starts)[np.cumsum(starts) - 1]]
    result = np.zeros(len(keys), np.int64)
    result[order] = np.where(least == own, 0, least + 1)
    return result


def _candidates(found: Words, told: np.ndarray, bits: int, min_words: int) -> np.ndarray:
    """First words of the runs of min_words words whose first and last minimiser have heads that occur again."""
    place = minimisers(found)
    at = _heads(found, place)
    _, key, counts = np.unique(B.coarse(window_hashes(found, HEAD, at), bits), return_inverse=True, return_counts=True)
    again = np.zeros(len(found.hash), bool)
    again[at] = (told[key] > 0) | (counts[key] > 1)
    runs = windows(found, min_words)
    return runs[again[place[runs]] & again[place[runs + min_words - REACH + 1]]]


def _chains(block: int, own: pa.Table, replies: pa.Table, min_words: int) -> pa.Table:
    """Pairs on one diagonal whose runs overlap, from the first to the last."""
    at, told = B.carried(replies), B.answers(replies, np.int64)
    if at is None:
        at = np.zeros(0, np.int64)
    keys = window_hashes(read_words(own.column("text")), min_words, at)
    order = np.argsort(keys, kind="stable")
    again = keys[order][1:] == keys[order][:-1]
    first = order[np.concatenate([[True], ~again])] if len(order) else order
    place = np.concatenate([at[order[1:][again]], at[first[told > 0]]])
    mate = np.concatenate([(block << _BLOCK_BITS) + at[order[:-1][again]], told[told > 0] - 1])
    along = np.lexsort((place, mate - place))
    place, mate = place[along], mate[along]
    breaks = (np.diff(mate - place) != 0) | (np.diff(place) >= min_words)
    starts = np.flatnonzero(np.concatenate([[True], breaks])) if len(place) else along
    stops = np.flatnonzero(np.concatenate([breaks, [True]])) if len(place) else along
    word = (1 << _BLOCK_BITS) - 1
    rows = (np.full(len(starts), block), place[starts], place[stops], mate[starts] >> _BLOCK_BITS, mate[starts] & word, mate[stops] & word)
    names = ["block", "first", "last", "mate_block", "mate_first", "mate_last"]
    return pa.table([pa.array(v.astype(np.int32 if n.endswith("block") else np.int64)) for n, v in zip(names, rows)], names=names)


def _ends(block: int, own: pa.Table, asked: pa.Table, min_words: int) -> pa.Table:
    """Where each chain begins, its words, the words before it, backwards, and those behind it."""
    found = read_words(own.column("text"))
    firsts, lasts = (asked.column(c).to_numpy() for c in ("first", "last"))
    rows, begins = found.row[firsts], found.first
    starts = begins[rows]
    stops = starts + found.counts[rows]
    after = lasts + min_words
    lefts = [found.hash[max(s, a - REACH) : a][::-1].tobytes() for s, a in zip(starts.tolist(), firsts.tolist())]
    rights = [found.hash[a : min(e, a + REACH)].tobytes() for e, a in zip(stops.tolist(), after.tolist())]
    ids = own.column("doc_id").combine_chunks().take(pa.array(rows)) if own.num_rows else pa.array([], pa.int64())
    texts = (np.int64(block) << _BLOCK_BITS) + rows.astype(np.int64)
    return pa.table(
        [asked.column("chain"), asked.column("side"), pa.array(texts), ids, pa.array(firsts - starts, pa.int64()), pa.array(after - firsts, pa.int64()), pa.array(lefts, pa.binary()), pa.array(rights, pa.binary())],
        names=["chain", "side", "text", "doc_id", "place", "n", "left_words", "right_words"],
    )


def _extended(batch: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    left = _common(batch, "left_words_0", "left_words_1")
    right = _common(batch, "right_words_0", "right_words_1")
    place, mate, n = (batch.column(c).to_numpy() for c in ("place", "mate_place", "n"))
    n = left + n + right
    table = pa.record_batch(
        [batch.column("doc_id"), pa.array(place - left), batch.column("mate_id"), pa.array(mate - left), pa.array(n), batch.column("within")],
        names=["doc_id", "start", "other_doc_id", "other_start", "n_words", "within"],
    )
    return table.filter(pa.array(n >= min_words))


def _common(batch: pa.RecordBatch, one: str, other: str) -> np.ndarray:
    result = np.zeros(batch.num_rows, np.int64)
    for i, (a, b) in enumerate(zip(batch.column(one).to_pylist(), batch.column(other).to_pylist())):
        n = min(len(a), len(b)) // 8
        same = np.frombuffer(a, np.uint64, n) == np.frombuffer(b, np.uint64, n)
        result[i] = n if same.all() else int(np.argmin(same))
    return result
