"""N-gram Jaccard join with several global token orders.

A document's set holds its distinct shingles of five words, A-Z lower-cased; with one to four words the whole
sequence is its one shingle; without words the set is empty and linked with nothing.  Two sets of n tokens
or more that reach similarity t must share one of the first n - ceil(t n) + 1 tokens of either under *every*
global order of tokens.  Three orders are used, all with tokens of one document first, which can match
nothing: rarest first, and two orders by hash.  Candidates come from the first order and must pass the other
two before their sets are compared exactly.

No group is expanded into all pairs.  Equal sets are one class.  Within the documents that share a prefix
token, each is compared with the one whose tokens are the most common; only documents of different
components are then compared with each other, so no link between components is lost.  Pairs are formed only where
the tokens that both still share with others suffice for the similarity.

* Rows that share a doc_id are one vertex that has each of their sets.
* A row without doc_id has no vertex: its component is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from . import blocks as B
from .components import components
from .words import Words, mix, read_words, window_hashes, windows

SHINGLE_WORDS = 5
SIMILARITY = 75  # percent
_SETS = (
    "doc_id bigint, n_shingles bigint, n_tokens int, commonness double, sum_1 bigint, sum_2 bigint,"
    " tokens array<bigint>, prefix_1 array<bigint>, prefix_2 array<bigint>, prefix_3 array<bigint>"
)
_LISTS = ("tokens", "prefix_1", "prefix_2", "prefix_3")
_SALTS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def shingles(found: Words, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, ordered by both."""
    at = windows(found, n)
    rows, hashes = [found.row[at]], [window_hashes(found, n, at)]
    for m in range(1, n):
        short = found.first[found.counts == m]
        rows.append(found.row[short])
        hashes.append(mix(window_hashes(found, m, short) + np.uint64(m)))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def token_sets(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Every document's set size; with it the tokens and prefixes of those documents of whose tokens enough
    occur in other documents for a link."""
    dealt = B.deal(docs)
    # Few bits: tokens only count as shared or order differently by chance, one in some hundreds.
    n_ranges, bits = dealt.n_ranges, dealt.coarse_bits - 6

    def first(block: int, own: pa.Table) -> list[tuple]:
        _, tokens = shingles(read_words(own.column("text"), lower=True))
        keys, counts = np.unique(B.coarse(tokens, bits), return_counts=True)
        return B.questions(block, keys, n_ranges, counts.astype(np.int64))

    def sets(block: int, own: pa.Table, replies: pa.Table) -> pa.Table:
        rows, tokens = shingles(read_words(own.column("text"), lower=True))
        _, key = np.unique(B.coarse(tokens, bits), return_inverse=True)
        return _sets(own, rows, tokens, B.answers(replies, np.int64)[key], similarity)

    return B.tell(dealt, B.answer(B.ask(dealt, first), _document_counts), sets, _SETS)


def _document_counts(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    _, key = np.unique(keys, return_inverse=True)
    totals = np.zeros(key.max() + 1 if len(key) else 0, np.int64)
    np.add.at(totals, key, counts)
    return totals[key]


def _sets(own: pa.Table, rows: np.ndarray, tokens: np.ndarray, df: np.ndarray, similarity: int) -> pa.Table:
    n = own.num_rows
    sizes = np.bincount(rows, minlength=n)
    shared = np.bincount(rows[df > 1], minlength=n)
    known = own.column("doc_id").is_valid().to_numpy()
    chosen = (100 * shared >= similarity * sizes) & (sizes > 0) & known
    prefix = sizes - -(-similarity * sizes // 100) + 1 - (sizes - shared)
    kept = (df > 1) & chosen[rows]
    row, token, count = rows[kept], tokens[kept], df[kept]
    rank = np.arange(len(row)) - np.repeat(np.cumsum(np.bincount(row, minlength=n)) - np.bincount(row, minlength=n), np.bincount(row, minlength=n))
    orders = [np.lexsort((mix(token), count, row)), *(np.lexsort((mix(token ^ s), row)) for s in _SALTS)]
    inside = rank < prefix[row]
    held = [(row, token), *((row[o][inside], token[o][inside]) for o in orders)]
    sums = [_wrapped_sums(rows, mix(tokens + s), n) for s in _SALTS]
    total = np.bincount(rows, weights=df, minlength=n)
    columns = [
        own.column("doc_id"),
        pa.array(sizes, pa.int64()),
        pa.array(sizes, pa.int32(), mask=~chosen),
        pa.array(total / np.maximum(sizes, 1)),
        *(pa.array(s) for s in sums),
        *(_lists(r, t, n, chosen) for r, t in held),
    ]
    return pa.table(columns, names=["doc_id", "n_shingles", "n_tokens", "commonness", "sum_1", "sum_2", *_LISTS])


def _wrapped_sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    ends = np.searchsorted(rows, np.arange(n + 1))
    return np.diff(sums[ends]).view(np.int64)


def _lists(rows: np.ndarray, tokens: np.ndarray, n: int, chosen: np.ndarray) -> pa.Array:
    offsets = np.searchsorted(rows, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens.view(np.int64)), mask=pa.array(~chosen))


def linked(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    sets = materialize(token_sets(docs, similarity), "token-sets")
    some = sets.where(F.col("n_tokens").isNotNull())
    classes = some.groupBy("n_tokens", "sum_1", "sum_2").agg(F.min("doc_id").alias("first_id"))
    members = some.select("doc_id", "n_tokens", "sum_1", "sum_2").join(classes, ["n_tokens", "sum_1", "sum_2"])
    members = materialize(members.select(F.col("doc_id").alias("a"), F.col("first_id").alias("b"), "n_tokens", "sum_1", "sum_2"), "classes")
    heads = members.where("a = b").select(F.col("b").alias("doc_id"), "n_tokens", "sum_1", "sum_2").distinct()
    # the number of tokens is taken before the exchange, so that the tokens stay behind
    heads = some.withColumn("n", F.size("tokens")).drop("tokens", "prefix_2", "prefix_3").join(heads, ["doc_id", "n_tokens", "sum_1", "sum_2"], "left_semi")
    # ``rest``: tokens of the document from this one on that others have too.  Two sets share no more than the
    # smaller rest at the first token they have in common.
    exploded = heads.select("doc_id", "n_tokens", "commonness", "n", F.posexplode("prefix_1").alias("rank", "token"))
    postings = materialize(exploded.withColumn("rest", F.col("n") - F.col("rank")).drop("n", "rank"), "postings")
    edges = members.select("a", "b")

    best = F.max_by(F.struct("doc_id", "n_tokens", "rest"), F.struct("commonness", -F.col("doc_id"))).alias("y")
    stars = postings.groupBy("token").agg(best, F.count("*").alias("n")).where("n > 1").drop("n")
    enough = F.expr(_enough("x", "y", similarity))
    pairs = postings.alias("x").join(stars, (F.col("x.token") == stars.token) & (F.col("x.doc_id") != F.col("y.doc_id")) & enough)
    pairs = pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    edges = materialize(edges.unionByName(_verified(pairs, sets, similarity)), "links")
    found = materialize(components(edges), "components")

    rest = materialize(_between(postings, found, similarity), "pairs")
    if rest.isEmpty():
        final = found
    else:
        final = components(edges.unionByName(_verified(rest, sets, similarity)))
    return sets.join(final, sets.doc_id == final.vertex, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _enough(x: str, y: str, similarity: int) -> str:
    """Whether two sets can still reach the similarity: s of the union is s / (1 + s) of the sum of sizes."""
    return f"{100 + similarity} * least({x}.rest, {y}.rest) >= {similarity} * ({x}.n_tokens + {y}.n_tokens)"


def _between(postings: DataFrame, found: DataFrame, similarity: int) -> DataFrame:
    """Pairs of different components that have a prefix token in common and can reach the similarity."""
    placed = postings.join(found, postings.doc_id == found.vertex, "left").select(
        "token", "doc_id", "n_tokens", "rest", F.coalesce("component", "doc_id").alias("component")
    )
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    placed = placed.join(mixed.select("token"), "token", "left_semi")
    one, other = placed.alias("x"), placed.alias("y")
    apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component"))
    joined = one.join(other, apart & F.expr(_enough("x", "y", similarity)))
    return joined.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs that share prefix tokens under the other orders too and whose sets reach the similarity.  Prefixes are
    fetched for the documents of pairs alone, whole sets for those of the pairs that pass."""
    shared = F.arrays_overlap("prefix_2_a", "prefix_2_b") & F.arrays_overlap("prefix_3_a", "prefix_3_b")
    passed = _beside(materialize(pairs, "pairs"), sets, "prefix_2", "prefix_3").where(shared).select("a", "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    similar = 100 * common >= similarity * (F.col("n_tokens_a") + F.col("n_tokens_b") - common)
    return _beside(materialize(passed, "pairs"), sets, "n_tokens", "tokens").where(similar).select("a", "b")


def _beside(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs with these columns of every set of both documents."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = sets.where(F.col("n_tokens").isNotNull()).select("doc_id", *columns).join(used, "doc_id", "left_semi")
    one, two = (some.select(F.col("doc_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)) for side in ("a", "b"))
    return pairs.join(one, "a").join(two, "b")
