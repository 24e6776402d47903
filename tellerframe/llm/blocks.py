"""Questions about the whole corpus, asked by blocks of documents and answered by ranges of hashes.

Documents are dealt to blocks by the hash of their doc_id and text, so rows without doc_id and rows of a
repeated one are spread too; only rows equal in both go to one block.  Each block sends the distinct
hashes it asks about, packed in one row for each range of hashes; the holder of a range sees
every block's hashes of that range and answers each block in the order in which it asked.
A hash therefore reaches its holder once for each block at most, however often it occurs:
a passage that a third of all documents share is as cheap as any other.

One exchange of the texts serves all steps of an operator: they read the same frame of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

BLOCK_BYTES = 8 << 20
LARGEST_PLAN = 64 << 30
ASKED = "range int, block int, keys binary, extra binary"
ANSWERED = "range int, block int, answer binary"


_ANSWER_KINDS = [pa.int32(), pa.int32(), pa.binary()]


@dataclass(frozen=True)
class Blocks:
    frame: DataFrame  # block, doc_id, text
    n_ranges: int
    block_bytes: int
    coarse_bits: int  # of a hash, for questions where a rare false "yes" costs only time


def deal(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Documents in blocks of about ``block_bytes`` of text.  Beyond 64 GiB of text, blocks and
    ranges both grow with the square root of the corpus, so that their product, the number of
    packed rows, grows only in proportion."""
    ship(docs.sparkSession)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    block_bytes = int(block_bytes * max(1.0, math.sqrt(total / LARGEST_PLAN)))
    n = max(1, math.ceil(total / block_bytes))
    frame = docs.select(
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")), F.lit(n)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return Blocks(frame, n, block_bytes, min(64, max(1, total).bit_length() + 12))


def coarse(keys: np.ndarray, bits: int) -> np.ndarray:
    """The highest bits of each hash: fewer bytes to send, and a few texts in a million share one by chance."""
    return keys & np.uint64((1 << 64) - (1 << (64 - bits)))


_ZSTD = pa.Codec("zstd", 1)


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def swell(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def planes(values: np.ndarray) -> bytes:
    """Any 8-byte numbers, byte plane by byte plane, compressed: small numbers take few bytes."""
    return squeeze(np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T).tobytes())


def unplanes(data: bytes, kind=np.uint64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(swell(data), np.uint8).reshape(8, -1).T).reshape(-1).view(kind)


def pack(keys: np.ndarray) -> bytes:
    """Sorted hashes as the differences between them."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data), dtype=np.uint64)


def _cuts(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """Where each range of hashes begins in sorted keys, with the end."""
    bounds = np.array([(r << 64) // n_ranges for r in range(1, n_ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]]).astype(np.int64)


def questions(block: int, keys: np.ndarray, n_ranges: int, extra: np.ndarray | None = None, offset: int = 0) -> list[tuple]:
    """Rows of ASKED for sorted distinct keys."""
    cuts = _cuts(keys, n_ranges)
    return [
        (r + offset, block, pack(keys[a:b]), planes(extra[a:b]) if extra is not None else None)
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        if b > a
    ]


def table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def asked(rows: list[tuple]) -> pa.Table:
    return table(rows, ["range", "block", "keys", "extra"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])


def _ordered(documents: pa.Table) -> pa.Table:
    """The rows of a block in an order that holds in every step: shuffles deliver them in any."""
    return documents.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def ask(blocks: Blocks, question: Callable[[int, pa.Table], list[tuple]]) -> DataFrame:
    """``question(block, documents)`` gives rows of ASKED."""

    def of(group: pa.Table) -> pa.Table:
        return asked(question(group.column("block")[0].as_py(), _ordered(group)))

    return blocks.frame.groupBy("block").applyInArrow(of, ASKED)


def answer(questions_: DataFrame, reply: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``reply(keys, extra)`` gets all blocks' keys of one range and returns one unsigned byte or 8-byte number for each."""

    def of(group: pa.Table) -> pa.Table:
        blocks_ = group.column("block").to_pylist()
        number = group.column("range")[0].as_py()
        if number < 0:
            return table([(number, b, k) for b, k in zip(blocks_, group.column("keys").to_pylist())], ["range", "block", "answer"], _ANSWER_KINDS)
        keys = [unpack(k) for k in group.column("keys").to_pylist()]
        extra = [unplanes(e, np.int64) if e is not None else np.zeros(0, np.int64) for e in group.column("extra").to_pylist()]
        sizes = np.array([len(k) for k in keys])
        told = reply(np.concatenate(keys), np.concatenate(extra))
        ends = np.cumsum(sizes)
        parts = [told[e - s : e] for s, e in zip(sizes, ends)]
        rows = [(number, b, squeeze(p.tobytes()) if p.dtype == np.uint8 else planes(p)) for b, p in zip(blocks_, parts)]
        return table(rows, ["range", "block", "answer"], _ANSWER_KINDS)

    return questions_.groupBy("range").applyInArrow(of, ANSWERED)


def carry(block: int, numbers: np.ndarray) -> tuple:
    """A row of ASKED that comes back to the block as it is: sorted numbers for its next step."""
    return -1 - block, block, pack(numbers.astype(np.uint64)), None


def carried(replies: pa.Table) -> np.ndarray | None:
    for number, data in zip(replies.column("range").to_pylist(), replies.column("answer")):
        if number < 0:
            return unpack(data.as_py()).astype(np.int64)
    return None


def answers(replies: pa.Table, kind=np.uint8) -> np.ndarray:
    """One block's answers in the order of its sorted keys."""
    replies = replies.filter(pa.compute.greater_equal(replies.column("range"), 0))
    order = np.argsort(replies.column("range").to_numpy())
    found = replies.column("answer").to_pylist()
    parts = [np.frombuffer(swell(found[i]), np.uint8) if kind is np.uint8 else unplanes(found[i], kind) for i in order]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def tell(blocks: Blocks, replies: DataFrame, use: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``use(block, documents, its answers)`` makes the rows of the result."""

    def of(documents: pa.Table, own: pa.Table) -> pa.Table:
        if not documents.num_rows:
            raise ValueError("an answer to a block without documents")
        return use(documents.column("block")[0].as_py(), _ordered(documents), own)

    return blocks.frame.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(of, schema)
