"""Words of whole Arrow text columns and their hashes, computed with numpy over the text buffers.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r.  Hashes are 64 bits wide
and the same in every process.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
_PIECE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_STEP = np.uint64(0xD1342543DE82EF95)


def words_column(text: Column | str) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of that name needs."""
    taken = {c.lower() for c in columns}
    return [next(n for i in range(1, len(taken) + 2) if (n := "_" * i + name) not in taken) for name in names]


@dataclass
class Words:
    """Words of some texts, text after text."""

    row: np.ndarray  # the text of each word
    hash: np.ndarray
    counts: np.ndarray  # words of each text

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word."""
        return np.cumsum(self.counts) - self.counts

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first + self.counts, self.counts) - np.arange(len(self.row))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, _PIECE_BYTES + 1), np.uint64(base))
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * _PIECE_BYTES:
            _POWERS[base] = have
    return have[:n]


_IS_WORD = np.ones(256, np.uint8)
_IS_WORD[[ord(c) for c in SPACES]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets); null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = _PIECE_BYTES):
    """Ranges of whole texts of about ``most`` bytes; a longer text is a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def read_words(texts, lower: bool = False, kinds: np.ndarray = _IS_WORD) -> Words:
    """All words of the texts.  ``lower`` folds A-Z only.  ``kinds`` gives a number to every byte: words
    are runs of one kind other than 0."""
    data, offsets = buffers(texts)
    hashes, counts = [], []
    for a, b in pieces(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        h, c = _hash_words(_LOWER[part] if lower else part, own, kinds)
        hashes.append(h)
        counts.append(c)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(np.repeat(np.arange(len(counts), dtype=np.int32), counts), hashes, counts)


def _hash_words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    kind = kinds[data]
    turns = np.ones(len(data) + 1, bool)
    turns[1:-1] = kind[1:] != kind[:-1]
    turns[offsets] = True
    starts = np.flatnonzero((kind > 0) & turns[:-1])
    stops = np.flatnonzero((kind > 0) & turns[1:]) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * _powers(_MULTIPLIER, len(data)), out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _powers(_INVERSE, len(data))[starts]
    return mix(hashes), np.diff(np.searchsorted(starts, offsets))


def windows(words: Words, n: int) -> np.ndarray:
    """First words of all runs of ``n`` words within one text."""
    return np.flatnonzero(words.left() >= n)


def window_hashes(words: Words, n: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``n`` words that begin at these words."""
    if not len(at):
        return np.zeros(0, np.uint64)
    size = len(words.hash) - n + 1
    rolled = words.hash[:size].copy()
    for j in range(1, n):
        rolled *= _STEP
        rolled += words.hash[j : size + j]
    return mix(rolled[at])
