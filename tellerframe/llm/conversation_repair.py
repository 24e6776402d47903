"""Conversations repaired by the cheapest edits, ties decided by the edits' letters.

A conversation fits if its roles' initials are ``(s?(ua)+)?``.  Rows may be kept (free), given the role user or
assistant (2) or deleted (3); rows with an empty text may be inserted anywhere (2); a truncated row that stays
costs 1 more; blank and repeated rows have to go.  The audit has one letter for each edit, in order: Delete,
Insert, Keep, Rerole.  Of the cheapest repairs the one with the least audit is made; it is unique.

Every node of a graph (rows done so far, last initial given out) holds one integer, the least over its edges: the
high digits are the cost of everything still to come, the low ones its letters, the next letter first, in a
fixed number of positions, with zeros behind the last.  An edge adds its cost and puts its letter before the others.
Comparing two integers compares costs, then audits.  Edges out of one node have different letters, so
letters further on never decide between them: long conversations are done in stretches of STRETCH rows from the end,
which hand on costs alone, and integers stay below a bounded size.

Spark orders and moves the rows.  Narrow rows (conversation, turn, role, digest of the text) are counted first, so that equal rows
are one row with a number; the first place of a repeated text is found by an aggregate and joined back, whatever the
conversation's length.  A task reads its conversations as a sorted stream and keeps one byte a row, no more
than the audit it has to return.  Texts are shuffled once and pass a task row by row, each conversation behind its audit;
none is held.

* Null roles and texts are one space; a null conv_id is a conversation of its own.
* Rows come by turn, nulls first; rows of one turn by role, then by the digest of their text.
* Texts are compared by MD5.  An initial is the first character of a role; an empty role has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import ship

STRETCH = 512
REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
REPAIRED = "conv_id bigint, place bigint, role string, text string"
_REPORT_KINDS = [pa.int64()] * 7 + [pa.string()]
_REPORT_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

# A row as one byte: what its initial is, whether it has to go, whether it is truncated.
_SYSTEM, _USER, _ASSISTANT, _OTHER = 1, 2, 3, 0
_GOES, _TRUNCATED = 4, 8
_CLASSES = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}

# What has been given out so far: nothing, s, and then u or a.
_NOTHING, _S, _U, _A = range(4)
_FINAL = (_NOTHING, _A)
_NEXT_USER = {_NOTHING: _U, _S: _U, _A: _U}
_NEXT_ASSISTANT = {_U: _A}
_NEXT = {_SYSTEM: {_NOTHING: _S}, _USER: _NEXT_USER, _ASSISTANT: _NEXT_ASSISTANT}
_INSERTED = {**_NEXT_USER, **_NEXT_ASSISTANT}
_KEEP, _REROLE, _DELETE, _INSERT = 0, 2, 3, 2
_ROLES = {"u": "user", "a": "assistant"}
_FITTING = ("su", "ua", "au")
_LETTERS = " DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_LETTER_BITS = 3


def _alternate(initial: str) -> str:
    return "a" if initial == "u" else "u"


class _Scalars:
    """Integers whose high digits are a cost and whose low digits are letters in ``positions`` places."""

    def __init__(self, positions: int):
        self.low = _LETTER_BITS * positions
        self.mask = (1 << self.low) - 1
        self.never = 1 << (self.low + 62)

    def of(self, cost: int) -> int:
        return cost << self.low

    def cost(self, value: int) -> int:
        return value >> self.low

    def edge(self, value: int, cost: int, letter: int) -> int:
        """``value`` behind an edge: its letters one place further on, the edge's letter before them."""
        letters = value & self.mask
        return value - letters + (cost << self.low) + (letter << (self.low - _LETTER_BITS)) + (letters >> _LETTER_BITS)

    def letters(self, value: int) -> str:
        found, at = [], self.low
        while at and (letter := value >> (at - _LETTER_BITS) & 7):
            found.append(_LETTERS[letter])
            at -= _LETTER_BITS
        return "".join(found)


def _with_inserts(values: list[int], scalars: _Scalars) -> list[int]:
    """The least with up to two insertions first: a third never pays."""
    best = list(values)
    for state, first in _INSERTED.items():
        second = _INSERTED[first]
        best[state] = min(
            values[state],
            scalars.edge(values[first], _INSERT, _I),
            scalars.edge(scalars.edge(values[second], _INSERT, _I), _INSERT, _I),
        )
    return best


def _before(code: int, after: list[int], scalars: _Scalars) -> list[int]:
    """The least for each state before a row, from those behind it."""
    edge, more = scalars.edge, 1 if code & _TRUNCATED else 0
    values = []
    for state in range(4):
        if code & _GOES:
            values.append(edge(after[state], _DELETE, _D))
            continue
        options = [edge(after[state], _DELETE, _D)]
        kept = _NEXT.get(code & 3, {}).get(state)
        if kept is not None:
            options.append(edge(after[kept], _KEEP + more, _K))
        options.append(edge(after[_INSERTED[state]], _REROLE + more, _R))
        values.append(min(options))
    return values


def _follow(state: int, letters: str, codes: bytes) -> int:
    """The state behind these letters."""
    row = 0
    for letter in letters:
        if letter == "K":
            state = _NEXT[codes[row] & 3][state]
        elif letter in "IR":
            state = _INSERTED[state]
        row += letter != "I"
    return state


def cheapest(codes: bytes, stretch: int = STRETCH) -> tuple[int, str]:
    """(cost, audit) of a conversation whose rows are ``codes``."""
    costs = [0 if s in _FINAL else None for s in range(4)]
    found = []  # (first row, the letters of each state), last stretch first
    for start in reversed(range(0, max(1, len(codes)), stretch)):
        part = codes[start : start + stretch]
        scalars = _Scalars(3 * len(part) + 2)
        values = [scalars.never if c is None else scalars.of(c) for c in costs]
        if not found:
            values = _with_inserts(values, scalars)
        for code in reversed(part):
            values = _with_inserts(_before(code, values, scalars), scalars)
        costs = [scalars.cost(v) for v in values]
        found.append((part, [scalars.letters(v) for v in values]))
    audit, state = [], _NOTHING
    for part, letters in reversed(found):
        audit.append(letters[state])
        state = _follow(state, letters[state], part)
    return costs[_NOTHING], "".join(audit)


# Short conversations are alike in their codes, whatever their texts.
_cheapest_of_few = lru_cache(maxsize=1 << 16)(cheapest)


def rows_of(conversations: DataFrame, copies: Column | int = 1) -> DataFrame:
    """conv_id, turn, role, text and the number of copies of each row, with nulls of role and text as one space, and
    what repair looks at: initial, fault and digest."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (copies if isinstance(copies, Column) else F.lit(copies)).cast("long").alias("copies"),
    )
    last = F.substring(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    code = F.when(last == "", _GOES).when(last.isin(".", "!", "?"), 0).otherwise(_TRUNCATED)
    return rows.withColumns({"digest": F.unhex(F.md5("text")), "fault": code})


def _narrow(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with their number, and whether the same role and text stand at a smaller turn."""
    keys = ["conv_id", "turn", "role", "digest"]
    counted = rows.groupBy(*keys, "fault").agg(F.sum("copies").alias("copies"))
    said = counted.where((F.col("fault") != _GOES) & (F.col("copies") > 0))
    repeated = said.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
    repeated = repeated.where("n > 1").select(*(F.col(c).alias(f"{c}_r") for c in ("conv_id", "role", "digest")), "first")
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_r")) & (F.col("role") == F.col("role_r")) & (F.col("digest") == F.col("digest_r"))
    joined = counted.join(repeated, same, "left")
    later = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    return joined.select(*keys, "fault", "copies", later.alias("later"))


def _streamed(rows: DataFrame, *order: str) -> DataFrame:
    """Whole conversations, one after the other, each in the order of its rows."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


class _Conversation:
    """What a task keeps of a conversation while its rows pass."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.initial = None

    def add(self, turn: int | None, role: str, fault: int, later: bool, copies: int) -> None:
        if not copies:
            return
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.turns == 0 else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        self.illegal += copies - 1  # a row and its copy never fit
        self.illegal += self.initial is not None and self.initial + initial not in _FITTING
        self.initial = initial
        kind = _CLASSES.get(initial, _OTHER)
        if fault == _GOES:
            self.blank += copies
            self.codes += bytes([kind | _GOES]) * copies
            return
        stays = 0 if later else 1
        self.duplicate += copies - stays
        self.truncated += stays if fault == _TRUNCATED else 0
        self.codes += bytes([kind | fault]) * stays + bytes([kind | _GOES]) * (copies - stays)

    def report(self) -> tuple:
        codes = bytes(self.codes)
        cost, audit = _cheapest_of_few(codes) if len(codes) <= 64 else cheapest(codes)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        gaps = min(gaps, (1 << 63) - 1)
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def verdicts(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (see :func:`rows_of`): conv_id, gaps (turns missing between the first and the
    last), blank, duplicate and truncated (rows by their first fault), illegal (neighbours whose initials are not su,
    ua or au), cost, audit.  A conversation whose rows have no copies has zeros and an empty audit; a number of turns missing beyond
    a long is the largest long."""
    ship(rows.sparkSession)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in _in_batches(_reports(batches), 4096):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), _REPORT_KINDS)], names=_REPORT_NAMES)

    stream = _streamed(_narrow(rows), "turn", "role", "digest").select("conv_id", "turn", "role", "fault", "later", "copies")
    return stream.mapInArrow(judged, REPORT)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    current = None
    for batch in batches:
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    yield current.report()
                current = _Conversation(conv_id)
            current.add(*row)
    if current is not None:
        yield current.report()


def _in_batches(rows: Iterator[tuple], most: int) -> Iterator[list[tuple]]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held


def _behind_audits(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows."""
    empty = {c: F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"), ("copies", "long"), ("audit", "string"))}
    heads = reports.select("conv_id", *(empty[c] for c in ("turn", "role", "digest", "text", "copies")), "audit", F.lit(0).alias("kind"))
    said = rows.where("copies > 0").select("conv_id", "turn", "role", "digest", "text", "copies", empty["audit"], F.lit(1).alias("kind"))
    return _streamed(heads.unionByName(said), "kind", "turn", "role", "digest").select("conv_id", "role", "text", "copies", "audit")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None, None) where a conversation begins, then (conv_id, role, text) of each row it has when repaired."""
    conv_id, letters, last, letter = None, iter(()), "a", ""

    def inserted() -> Iterator[tuple]:
        """Rows inserted before the next row, whose letter is then in ``letter``."""
        nonlocal last, letter
        for letter in letters:
            if letter != "I":
                return
            last = _alternate(last)
            yield conv_id, _ROLES[last], ""

    for batch in batches:
        for conv, role, text, copies, audit in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                yield from inserted()  # those behind the last row of the conversation before
                conv_id, letters, last = conv, iter(audit), "a"
                yield conv_id, None, None
                continue
            for _ in range(copies):
                yield from inserted()
                if letter == "K":
                    last = role[:1]
                    yield conv_id, role, text
                elif letter == "R":
                    last = _alternate(last)
                    yield conv_id, _ROLES[last], text
    yield from inserted()


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place (from 0), role, text."""
    ship(rows.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed():
            place = 0
            for conv_id, role, text in _edited(batches):
                if role is None:
                    place = 0
                else:
                    yield conv_id, place, role, text
                    place += 1

        for done in _in_batches(placed(), 256):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), [pa.int64(), pa.int64(), pa.string(), pa.string()])], names=["conv_id", "place", "role", "text"])

    return _behind_audits(rows, reports).mapInArrow(made, REPAIRED)


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of every conversation: of ``role:text`` of its repaired rows, joined by newlines."""
    ship(rows.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums():
            conv, digest, first = None, None, True
            for conv_id, role, text in _edited(batches):
                if role is None:
                    if digest is not None:
                        yield conv, digest.hexdigest()
                    conv, digest, first = conv_id, hashlib.sha256(), True
                else:
                    digest.update((("" if first else "\n") + f"{role}:{text}").encode())
                    first = False
            if digest is not None:
                yield conv, digest.hexdigest()

        for done in _in_batches(sums(), 4096):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), [pa.int64(), pa.string()])], names=["conv_id", "repaired_sha256"])

    return _behind_audits(rows, reports).mapInArrow(hashed, "conv_id bigint, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the checksum of ``conv_id:turn``, as :func:`rows_of` gives them: of 20 rows one has no
    copy, one no text, one no ``.!?``, one is there twice, one has the role user."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    named = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rows = rows.withColumn("fate", F.crc32(F.concat_ws(":", *named)) % 20)
    fate = F.col("fate")
    changed = rows.withColumns(
        {
            "text": F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "role": F.when(fate == 4, "user").otherwise(F.col("role")),
        }
    )
    return rows_of(changed, F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))
