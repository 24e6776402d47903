"""Token sequences of a fixed length, packed by minimum bin slack.

Every document becomes its token ids and one id that ends it.  Whole multiples of the capacity are sequences of
their own; what remains of each document waits in a pool by length.  A sequence begins with the longest waiting piece;
a subset-sum over the other waiting lengths, one bit for each total, finds the multiset that comes closest to the
capacity, and walking the bits back gives how many pieces of each length it takes.  A gap that no multiset
fills takes the beginning of another piece, whose rest waits on.  What is left at the end of a partition is cut
into powers of two, which need no padding, so that no sequence is padded at all.

The texts are never shuffled: each task packs the partition it reads, holds at most POOL pieces of fewer ids than
the capacity and one document's ids, and numbers its sequences below its partition's number.  A lost task packs the same rows
again.

* A null or empty text has no ids but the one that ends it.
* Repeated rows, repeated doc_ids and null ones are documents of their own.
* The name of a special token inside a text is ordinary text.
* Very long texts are encoded in slices cut where a word begins, which changes no id.
"""

from __future__ import annotations

import itertools
import os
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .words import buffers

CAPACITY = 1024
POOL = 4096  # pieces that wait for a sequence in a task
_SLICE = 4 << 20  # bytes encoded at a time
_TOGETHER = 100  # unknown words
_CACHED_WORDS, _CACHED_LENGTH = 1_000_000, 64
_OUT_BYTES = 4 << 20
_ID_BYTES = 4
_PARTITION_BITS = 33  # a sequence is a number within a partition: partition << _PARTITION_BITS | number
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


_LETTER, _DIGIT, _MARK, _APOSTROPHE = 1, 2, 3, 4


def _byte_kinds() -> np.ndarray:
    """Letters, digits, marks and the apostrophe of ASCII; 0 for all other bytes."""
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = _MARK
    kinds[np.frombuffer(string.ascii_letters.encode(), np.uint8)] = _LETTER
    kinds[np.frombuffer(string.digits.encode(), np.uint8)] = _DIGIT
    kinds[ord("'")] = _APOSTROPHE
    return kinds


_BYTE_KINDS = _byte_kinds()


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers, for byte-level vocabularies with GPT-2's pattern of words.

    A text is cut where a word of the pattern begins whatever stands around it: at a space before a visible character, before
    and behind a single line end, and between letters, digits and marks.  Arrow finds the distinct parts of many texts at once;
    those not met yet are encoded together, a line for each, as a line's end is always an id of its own."""

    # A space with a visible character behind it always begins a new word of the vocabulary's pattern, and
    # nothing before it depends on what follows.
    _BEGIN = re.compile(rb" (?=[\x21-\x7e\xc3-\xe0\xe4-\xf4])")
    _PLAIN = re.compile(r" ?\S+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        # an ordinary added token may hold letters and marks: then words stay whole
        self._inside = all(t.special for t in self._tokenizer.get_added_tokens_decoder().values())
        self._known: dict[str, bytes] = {}
        (self._line_end,) = self._ids("\n")

    def __call__(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.large_string())))

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; a null one is empty."""
        data, offsets = buffers(texts)
        at, n = 0, len(offsets) - 1
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, side="right")) - 1)
            if end == at + 1 and offsets[end] - offsets[at] > _SLICE:
                yield self._long(data[offsets[at] : offsets[end]])
            else:
                yield from self._slices(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
            at = end

    def _long(self, data: np.ndarray) -> bytes:
        whole, parts, at = data.tobytes(), [], 0
        while at < len(whole):
            cut = self._BEGIN.search(whole, at + _SLICE)
            end = cut.start() if cut else len(whole)
            parts += self._slices(data[at:end], np.array([0, end - at]))
            at = end
        return b"".join(parts)

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _slices(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        if not len(data):
            return [b""] * (len(offsets) - 1)
        starts = self._starts(data, offsets)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data))
        words = words.dictionary_encode()
        ids = pa.array(self._of_words(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        _, ends, found = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(starts) + 1][np.searchsorted(starts, offsets)].tolist()
        found = found.to_pybytes() if found is not None else b""
        return [found[a:b] for a, b in zip(ends, ends[1:])]

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the parts of some texts begin; ``offsets`` are the texts' own."""
        kinds = _BYTE_KINDS[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[_before_visible(data)] = True
        line_ends = np.flatnonzero(data[1:-1] == ord("\n")) + 1
        line_ends = line_ends[(kinds[line_ends - 1] > 0) & (kinds[line_ends + 1] > 0)]
        begins[line_ends] = begins[line_ends + 1] = True
        begins[offsets[1:][np.diff(offsets) > 0] - 1] = False  # what follows a text's last byte is another text
        if self._inside:
            latin = np.flatnonzero(data[:-1] == 0xC3)  # the letters of Latin-1, all but its two signs
            latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
            kinds[latin] = kinds[latin + 1] = _LETTER
            # an apostrophe may take letters behind it, and marks before it
            before, after = kinds[:-1], kinds[1:]
            other = (before != after) & (before > 0) & (after > 0) & (before < _APOSTROPHE)
            begins[1:-1] |= other & ~((before == _MARK) & (after == _APOSTROPHE))
        begins[offsets] = True
        return np.flatnonzero(begins[:-1])

    def _of_words(self, words: list[str]) -> list[bytes]:
        known = self._known
        ids = list(map(known.get, words))
        missing = [w for w, i in zip(words, ids) if i is None]
        if missing:
            new = {}
            for at in range(0, len(missing), _TOGETHER):
                new.update(self._new(missing[at : at + _TOGETHER]))
            ids = [new[w] if i is None else i for w, i in zip(words, ids)]
            known.update((w, i) for w, i in new.items() if len(w) <= _CACHED_LENGTH)
            if len(known) > _CACHED_WORDS:  # the oldest half goes; words that are still in use come back
                for w in list(known)[: len(known) // 2]:
                    del known[w]
        return ids

    def _new(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        plain = list(filter(self._PLAIN.fullmatch, words))
        found = np.array(self._ids("\n".join(plain)), "<u4")
        ends = (np.flatnonzero(found == self._line_end) * _ID_BYTES).tolist()
        ids = found.tobytes()
        lines = zip(plain, map(ids.__getitem__, map(slice, [0, *(e + _ID_BYTES for e in ends)], [*ends, len(ids)])))
        if len(plain) == len(words):
            return lines
        others = (w for w in words if not self._PLAIN.fullmatch(w))
        return itertools.chain(lines, ((w, np.array(self._ids(w), "<u4").tobytes()) for w in others))


def _before_visible(data: np.ndarray) -> np.ndarray:
    """The spaces with a visible character behind them."""
    spaces = np.flatnonzero(data[:-1] == ord(" "))
    lead, second, third = (data[np.minimum(spaces + i, len(data) - 1)] for i in (1, 2, 3))
    # Behind these first bytes there are spaces of Unicode too: U+0085, U+00A0, U+1680, U+180E, U+2000 to U+205F, U+3000.
    e1 = (lead == 0xE1) & (second != 0x9A) & (second != 0xA0)
    e2 = (lead == 0xE2) & ((second > 0x81) | (second == 0x80) & (third > 0x8A) & (third != 0xA8) & (third != 0xA9) & (third != 0xAF))
    e3 = (lead == 0xE3) & ((second != 0x80) | (third != 0x80))
    return spaces[(_BYTE_KINDS[lead] > 0) | (lead > 0xC2) & (lead < 0xE1) | (lead > 0xE3) | e1 | e2 | e3]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """The same for all tasks of a Python worker, which keeps the words it knows."""
    return Encoder(path)


def closest_subset(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length (``counts``: length to number) to take so that their total is the largest up to
    ``room``.  Bit s of a reachable set says whether some of the lengths so far have the total s."""
    within = (1 << (room + 1)) - 1
    reachable, steps = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        before = reachable
        left, batch = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... of this length, then the rest: any number up to ``left``
            take = min(batch, left)
            reachable |= (reachable << take * length) & within
            left, batch = left - take, 2 * batch
        steps.append((length, before))
        if reachable >> room:
            break
    total = reachable.bit_length() - 1
    taken = {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:  # the fewest of this length that leave a total the longer ones reach
            total, n = total - length, n + 1
        if n:
            taken[length] = n
    return taken


class Packer:
    """Pieces of documents in, rows of sequences out."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity = capacity
        self.sequence = first_sequence
        self.waiting: dict[int, list[tuple]] = {}  # length -> (doc_id, start, ids, doc_tokens)
        self.pieces = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n = len(ids) // _ID_BYTES
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._sequence([(doc_id, start, ids[start * _ID_BYTES : (start + self.capacity) * _ID_BYTES], n)])
        if whole < n:
            self._wait((doc_id, whole, ids[whole * _ID_BYTES :], n))
        while self.pieces >= POOL:
            yield from self._fill()

    def end(self) -> Iterator[tuple]:
        while sum(length * len(p) for length, p in self.waiting.items()) >= self.capacity:
            yield from self._fill()
        left = sorted((p for pieces in self.waiting.values() for p in pieces), key=lambda p: -len(p[2]))
        total = sum(len(p[2]) for p in left) // _ID_BYTES
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                room, chosen = 1 << bit, []
                while room:
                    head, rest = _cut(left.pop(0), room)
                    chosen.append(head)
                    room -= len(head[2]) // _ID_BYTES
                    if rest:
                        left.insert(0, rest)
                yield from self._sequence(chosen)

    def _wait(self, piece: tuple) -> None:
        self.waiting.setdefault(len(piece[2]) // _ID_BYTES, []).append(piece)
        self.pieces += 1

    def _take(self, length: int) -> tuple:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[length]
        self.pieces -= 1
        return piece

    def _fill(self) -> Iterator[tuple]:
        """One sequence, while the waiting pieces are long enough for it."""
        longest = max(self.waiting)
        chosen, room = [self._take(longest)], self.capacity - longest
        for length, n in closest_subset({k: len(p) for k, p in self.waiting.items()}, room).items():
            chosen += [self._take(length) for _ in range(n)]
            room -= n * length
        if room and self.waiting:  # the lengths left are all longer than the gap
            head, rest = _cut(self._take(max(self.waiting)), room)
            chosen.append(head)
            self._wait(rest)
        yield from self._sequence(chosen)

    def _sequence(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, n in pieces:
            length = len(ids) // _ID_BYTES
            yield doc_id, start, length, ids, n, self.sequence, offset
            offset += length
        self.sequence += 1


def _cut(piece: tuple, room: int) -> tuple[tuple, tuple | None]:
    doc_id, start, ids, n = piece
    if len(ids) <= room * _ID_BYTES:
        return piece, None
    return (doc_id, start, ids[: room * _ID_BYTES], n), (doc_id, start + room, ids[room * _ID_BYTES :], n)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece of a document of ``docs`` (doc_id, text): doc_id, start (ids of its document before it),
    length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (ids of its sequence before it).
    ``tokenizer`` is the path of a byte-level vocabulary that every executor has."""
    if capacity < 1:
        raise ValueError("a sequence holds one id or more")
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        packer = Packer(capacity, TaskContext.get().partitionId() << _PARTITION_BITS)
        yield from _batches(row for batch in batches for row in _packed(batch, encode, packer, end))
        yield from _batches(packer.end())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack, PIECES)


def _packed(batch: pa.RecordBatch, encode: Encoder, packer: Packer, end: bytes) -> Iterator[tuple]:
    for doc_id, ids in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1))):
        yield from packer.add(doc_id, ids + end)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) + 64
        if size >= _OUT_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in _NAMES]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)
