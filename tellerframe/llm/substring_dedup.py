"""Substring dedup by level-wise doubling.

Level 1 asks which windows of ``words / 2**doublings`` words occur more than once.  Only where both
halves of a window of twice that length are repeated is that window a candidate of the next level, and so
on up to ``words``; nothing is asked any more once no candidates survive.  At the last level each candidate
window learns by its full hash whether its word sequence also starts earlier, and the words of those that
do are removed.  The levels before ask about shortened hashes: a chance hit there only makes one more
candidate.

* Order: smaller doc_id first, then the earlier start in the same row.  Rows that share a doc_id are
  documents of their own of which none is earlier, so neither loses words to the other.
* A null doc_id is later than every other.  Null, empty and short texts lose nothing.
* All positions of all texts take part; nothing is sampled or capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .words import read_words, window_hashes, windows

REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<start:bigint,end:bigint>>"
_REMOVED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
_LAST_ID = np.iinfo(np.int64).max


def repeated_words(docs: DataFrame, words: int = 20, doublings: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_removed, the SHA-256 of the kept words, and the
    word ranges [start, end) removed."""
    if doublings < 1 or words % (1 << doublings):
        raise ValueError("words must be a multiple of 2 ** doublings, and doublings 1 or more")
    dealt = B.deal(docs)
    n_ranges, bits, shortest = dealt.n_ranges, dealt.coarse_bits, words >> doublings

    def first(block: int, own: pa.Table) -> list[tuple]:
        found = read_words(own.column("text"))
        keys = B.coarse(window_hashes(found, shortest, windows(found, shortest)), bits)
        return B.questions(block, np.unique(keys), n_ranges)

    def level(length: int):
        """From what is known of windows of half the length to questions about ``length``."""

        def doubled(block: int, own: pa.Table, replies: pa.Table) -> pa.Table:
            found = read_words(own.column("text"))
            candidates = _doubled(found, replies, length // 2, bits)
            keys = window_hashes(found, length, candidates)
            if length < words:
                rows = B.questions(block, np.unique(B.coarse(keys, bits)), n_ranges)
            else:
                unique, at = np.unique(keys, return_inverse=True)
                rows = B.questions(block, unique, n_ranges, _least(at, _ids(own)[found.row[candidates]], len(unique)))
            return B.asked([B.carry(block, candidates), *rows])

        return doubled

    told = B.answer(B.ask(dealt, first), _elsewhere)
    for k in range(1, doublings + 1):
        told = B.answer(B.tell(dealt, told, level(shortest << k), B.ASKED), _elsewhere if k < doublings else _earlier)

    def removal(block: int, own: pa.Table, replies: pa.Table) -> pa.Table:
        return _remove(own, replies, words)

    return B.tell(dealt, told, removal, REMOVED)


def _doubled(found, replies: pa.Table, half: int, bits: int) -> np.ndarray:
    """Starts of windows of twice the length whose halves are both repeated."""
    at = B.carried(replies)
    at = windows(found, half) if at is None else at
    _, key, counts = np.unique(B.coarse(window_hashes(found, half, at), bits), return_inverse=True, return_counts=True)
    repeated = np.zeros(len(found.hash) + half, bool)
    repeated[at[(counts[key] > 1) | (B.answers(replies)[key] > 0)]] = True
    return np.flatnonzero(repeated[:-half] & repeated[half:] & (found.left() >= 2 * half))


def _elsewhere(keys: np.ndarray, _: np.ndarray) -> np.ndarray:
    """1 where another block asked for the same key."""
    _, key, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return (counts[key] > 1).astype(np.uint8)


def _earlier(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """1 where a document of another block has the key and a smaller doc_id."""
    unique, key = np.unique(keys, return_inverse=True)
    return (_least(key, ids, len(unique))[key] < ids).astype(np.uint8)


def _least(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, _LAST_ID)
    np.minimum.at(least, groups, values)
    return least


def _ids(own: pa.Table) -> np.ndarray:
    return own.column("doc_id").fill_null(_LAST_ID).to_numpy()


def _remove(own: pa.Table, replies: pa.Table, length: int) -> pa.Table:
    found = read_words(own.column("text"))
    at = B.carried(replies)
    at = np.zeros(0, np.int64) if at is None else at
    unique, key = np.unique(window_hashes(found, length, at), return_inverse=True)
    ids, row = _ids(own)[found.row[at]], found.row[at]
    earlier = (B.answers(replies)[key] > 0) | (_least(key, ids, len(unique))[key] < ids)
    order = np.lexsort((at, row, key))
    again = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    earlier[order[1:][again]] = True
    edges = np.zeros(len(found.hash) + length + 1, np.int32)
    np.add.at(edges, at[earlier], 1)
    np.add.at(edges, at[earlier] + length, -1)
    gone = np.cumsum(edges[: len(found.hash)]) > 0
    removed = np.bincount(found.row[gone], minlength=own.num_rows)
    first = found.first
    digests, spans = [], []
    for i, text in enumerate(own.column("text")):
        own_words = (text.as_py() or "").encode().split()
        if removed[i]:
            own_gone = gone[first[i] : first[i] + len(own_words)]
            own_words = [w for w, g in zip(own_words, own_gone.tolist()) if not g]
            turns = np.flatnonzero(np.diff(own_gone, prepend=False, append=False)).tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])])
        else:
            spans.append([])
        digests.append(hashlib.sha256(b" ".join(own_words)).hexdigest())
    return pa.table(
        [own.column("doc_id"), pa.array(found.counts, pa.int64()), pa.array(removed, pa.int64()), digests, pa.array(spans, _REMOVED.field("removed").type)],
        schema=_REMOVED,
    )
