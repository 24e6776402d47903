"""Whitening, conversation repair and packing against plain versions."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellerframe.llm import conversation_repair, packing, registry, whitening
from tellerframe.sources.storage import materialize

from . import plain

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# Whitening


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    return df.withColumns({c: F.lit("x") for c in ("x", "n", "component", "row", "part", "label")})


def checked(df, rows, width, components=16):
    """The result against exact sums and an eigendecomposition of the exact covariance."""
    kept = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    exact = [[n * x - s for x, s in zip(v, sums)] for v in distinct]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in exact), n**3)) for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    got = defaultdict(list)
    result = df.collect()
    for r in result:
        got[r.component].append(r)
    assert {r.n for r in result} == {n}
    assert Counter(r.vec_id for r in got[1]) == Counter(i for i, _ in rows)
    exactly = ((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept)
    deviation = Counter((i, d if d < 1 << 63 else None) for i, d in exactly)
    for component, own in got.items():
        assert Counter((r.vec_id, r.deviation) for r in own) == deviation
        assert own[0].explained == pytest.approx(values[component - 1] / values.sum(), rel=1e-4)
        assert own[0].identity_error < 1e-4
        raw = Counter()
        for i, x in kept:
            raw[(i, round(abs(float(np.dot([(n * a - s) / n for a, s in zip(x, sums)], axes[:, component - 1]) / np.sqrt(values[component - 1]))), 5))] += 1
        assert sorted(r.vec_id or -1 for r in own) == sorted(i or -1 for i, _ in rows)
        mine = sorted((r.vec_id or -1, abs(r.whitened)) for r in own)
        assert np.allclose([v for _, v in mine], [v for _, v in sorted((i or -1, v) for (i, v), k in raw.items() for _ in range(k))], atol=1e-4)
    return got


def test_whitening(spark):
    draw = np.random.default_rng(1)
    mixed = draw.normal(size=(400, 20)) @ draw.normal(size=(20, 20)) * np.linspace(0.1, 3, 20)
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(None, mixed[0].tolist()), (7, mixed[3].tolist()), (7, mixed[3].tolist())]
    odd = [(900, None), (901, []), (902, [None, *[1.0] * 19]), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (905, [1e300] * 20)]
    got = whitening.whitened(vectors(spark, rows + odd + [(906, [1.0, 2.0])]))
    short = got.where("vec_id = 906").collect()
    assert [(r.component, r.n, r.deviation) for r in short] == [(None, None, None)]
    found = checked(got.where("vec_id IS NULL OR vec_id != 906"), rows, 20)
    assert sorted(found) == list(range(1, 17))


def test_whitening_of_stretched_vectors(spark):
    """Deviations 300,000 times as large in one direction as in another."""
    draw = np.random.default_rng(2)
    turned, _ = np.linalg.qr(draw.normal(size=(8, 8)))
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(300, 8)) * 10.0 ** np.linspace(-0.5, 5, 8) @ turned)]
    found = checked(whitening.whitened(vectors(spark, rows), shift=1_000_000), rows, 8)
    assert sorted(found) == list(range(1, 9))


def test_whitening_without_full_rank(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(50, 3))
    rows = [(i, [*v, v[0], 5.0, *v[::-1]]) for i, v in enumerate(base.tolist())]
    found = checked(whitening.whitened(vectors(spark, rows)), rows, 8)
    assert sorted(found) == [1, 2, 3]
    few = checked(whitening.whitened(vectors(spark, rows[:3])), rows[:3], 8)
    assert sorted(few) == [1, 2]


def test_whitening_of_huge_entries_is_exact(spark):
    rows = [(i, [float(2**50 * i), float(i % 2)]) for i in range(9)]
    got = {(r.vec_id, r.n) for r in whitening.whitened(vectors(spark, rows)).where("deviation IS NULL").collect()}
    assert got == {(i, 9) for i in range(9) if i != 4}


def test_whitening_of_equal_vectors_and_of_none(spark):
    rows = [(i, [1.0, 2.0]) for i in range(5)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened) for r in got] == [(None, 1, 0, None)] * 5
    assert whitening.whitened(vectors(spark, [(1, None)])).count() == 0
    assert whitening.whitened(vectors(spark, rows).where("false")).count() == 0


# Conversations


def rows_after_damage(conversations):
    rows = defaultdict(list)
    for conv, turn, role, text in conversations:
        own = rows[conv]
        blank = lambda v: " " if v is None else str(v)
        role, text, fate = blank(role), blank(text), zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fate == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    import hashlib

    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest())
    return {c: sorted(own, key=order) for c, own in rows.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        visible = text.strip(" \t\n\x0b\x0c\r")
        if not visible:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def plain_repair(rows, found):
    """The least (cost, audit) with the rows it gives, by trying every edit from the last row to the first."""
    states = {"": "su", "s": "u", "u": "a", "a": "u"}
    roles = {"u": "user", "a": "assistant"}
    best = {(s, 0): (0, "", ()) for s in ("", "a")}

    def inserting(level):
        for _ in range(3):
            for s, following in states.items():
                for x in following:
                    if x in roles and (x, 0) in level:
                        cost, audit, out = level[x, 0]
                        new = (cost + 2, "I" + audit, ((roles[x], ""), *out))
                        if (s, 0) not in level or new[:2] < level[s, 0][:2]:
                            level[s, 0] = new
        return level

    best = inserting(best)
    for (_, role, text), fault in reversed(list(zip(rows, found))):
        level = {}
        for s, following in states.items():
            options = []
            if (s, 0) in best:
                cost, audit, out = best[s, 0]
                options.append((cost + 3, "D" + audit, out))
            if fault not in ("blank", "duplicate"):
                for x in following:
                    if (x, 0) not in best:
                        continue
                    cost, audit, out = best[x, 0]
                    more = fault == "truncated"
                    if role[:1] == x:
                        options.append((cost + more, "K" + audit, ((role, text), *out)))
                    if x in roles:
                        options.append((cost + 2 + more, "R" + audit, ((roles[x], text), *out)))
            if options:
                level[s, 0] = min(options, key=lambda o: o[:2])
        best = inserting(level)
    return best["", 0]


def plain_reports(conversations):
    import hashlib

    after = rows_after_damage(conversations)
    for conv, rows in after.items():
        found = faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, out = plain_repair(rows, found)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        yield (conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


@pytest.fixture(scope="module")
def odd_conversations():
    draw = random.Random(5)
    rows = []
    texts = ["Yes.", "No", "Well!", "", " \n", None, "Again?", "Bis morgen.", "a b c.  ", "Ä\x85"]
    for conv in [*range(300), None]:
        for turn in range(draw.choice([1, 2, 3, 4, 5, 8, 12])):
            role = draw.choice(["user", "assistant"] if draw.random() < 0.8 else ["system", "tool", "", None, "s", "upper", "User"])
            if draw.random() < 0.6:
                role = ("user", "assistant")[turn % 2]
            number = draw.choice([turn, turn, turn, turn, turn * 3, None, turn // 2])
            rows.append((conv, number, role, draw.choice(texts) if draw.random() < 0.4 else f"Text {turn} of it."))
    rows += [(1000, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(1500)]
    rows += [(1001, 1, "user", "The same.")] * 700 + [(1002, t, "user", "The same.") for t in range(300)]
    return rows


@pytest.fixture(scope="module")
def conversations(spark, odd_conversations):
    df = spark.createDataFrame(odd_conversations, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    return df.withColumns({c: F.lit("x") for c in ("copies", "digest", "fault", "kind", "audit", "fate", "first", "place")})


def test_conversation_repair(spark, odd_conversations, conversations, tmp_path):
    conversations.write.parquet(f"{tmp_path}/conversations.parquet")
    got = registry.conversation_repairs(spark, str(tmp_path))
    assert Counter(tuple(r) for r in got.collect()) == Counter(plain_reports(odd_conversations))


def test_repaired_rows_fit(conversations):
    rows = conversation_repair.damaged(conversations)
    made = conversation_repair.repaired(rows, materialize(conversation_repair.verdicts(rows), "reports")).collect()
    by_conversation = defaultdict(list)
    for r in made:
        by_conversation[r.conv_id].append((r.place, r.role))
    assert by_conversation
    for placed in by_conversation.values():
        placed.sort()
        assert [p for p, _ in placed] == list(range(len(placed)))
        initials = "".join(role[:1] for _, role in placed)
        assert initials.removeprefix("s").replace("ua", "") == "" and initials != "s"


def test_audits_of_all_short_conversations():
    """Every conversation of up to four rows, in one stretch and in stretches of one or two rows."""
    kinds = {1: ("system", ""), 2: ("user", ""), 3: ("assistant", ""), 0: ("tool", ""), 2 | 4: ("user", "blank"), 3 | 8: ("assistant", "truncated"), 8: ("tool", "truncated")}
    for n in range(5):
        for codes in itertools.product(kinds, repeat=n):
            rows = [(None, kinds[c][0], "") for c in codes]
            wanted = plain_repair(rows, [kinds[c][1] for c in codes])[:2]
            for stretch in (512, 1, 2):
                assert conversation_repair.cheapest(bytes(codes), stretch) == wanted


def test_audits_of_long_conversations():
    draw = random.Random(6)
    for _ in range(30):
        codes = bytes(draw.choice([1, 2, 2, 3, 3, 0, 6, 7, 10, 11]) for _ in range(draw.randrange(40, 400)))
        assert conversation_repair.cheapest(codes, 16) == conversation_repair.cheapest(codes, 1 << 20)


def test_no_conversations(spark, conversations, tmp_path):
    conversations.where("false").write.parquet(f"{tmp_path}/conversations.parquet")
    assert registry.conversation_repairs(spark, str(tmp_path)).count() == 0


# Packing


@lru_cache
def plain_tokenizer():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=None)
def encoded(text):
    tokenizer = plain_tokenizer()
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_do_not_depend_on_slices(monkeypatch):
    monkeypatch.setattr(packing, "_SLICE", 7)
    monkeypatch.setattr(packing, "_CACHED_WORDS", 20)
    draw = random.Random(8)
    encode, tokenizer = packing.Encoder(VOCABULARY), plain_tokenizer()
    texts = ["", " ", "  a", "a \n b\n\n  c\t d ", "x\x1c y　 z \x85 q", "it's   'll <|endoftext|> a", " \n "]
    texts += ["".join(draw.choice(" \n\tab1!'sé　\x1c\x85½") for _ in range(60)) for _ in range(500)]
    for text in texts:
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_ids_of_many_texts_at_once(monkeypatch, size):
    """No text changes its neighbours' ids, null and empty ones included, and words are met by their letters alone: marks and
    digits around them make no new ones."""
    monkeypatch.setattr(packing, "_SLICE", size)
    monkeypatch.setattr(packing, "_TOGETHER", 5)
    draw = random.Random(11)
    encode, tokenizer = packing.Encoder(VOCABULARY), plain_tokenizer()
    texts = [None, "", "a  ", "b", "\n", "\nc", "d\n", "e", " ", "\u201eü\u201c \u201eÄ\u201c", "ü's×÷ß'll", "\u3000 \u2003 日本 \u3000", "", None]
    texts += ["".join(draw.choice("  \nabtsl1!'(\"é×\u3000\x85½日\u201e\u2003е") for _ in range(draw.randrange(30))) for _ in range(2000)]
    wanted = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(encode.texts(pa.array(texts))) == wanted
    assert list(encode.texts(pa.chunked_array([texts[:9], texts[9:]]))) == wanted
    assert list(encode.texts(pa.array(texts)[3:99])) == wanted[3:99] and not list(encode.texts(pa.array([], pa.string())))
    encode = packing.Encoder(VOCABULARY)
    list(encode.texts(pa.array([" zebra", " zebra,", " zebra!)", " zebra7", "(zebra)"])))
    assert sum("zebra" in w for w in encode._known) == 2


@pytest.mark.parametrize("capacity", [1024, 100])
def test_packing(odd_docs, odd_rows, capacity):
    got = packing.packed(odd_docs, VOCABULARY, capacity).collect()
    texts = Counter(tuple(encoded(r[1])) for r in odd_rows[0])
    sequences, ends, starts = defaultdict(list), Counter(), defaultdict(Counter)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.length == len(ids) > 0 and r.start + r.length <= r.doc_tokens
        sequences[r.sequence_id].append((r.offset, r.length))
        ends[r.doc_id] += r.length
        starts[r.doc_id, r.doc_tokens][(r.start, r.length)] += 1
    wanted = Counter()
    for doc, text, *_ in odd_rows[0]:
        wanted[doc] += len(encoded(text))
    assert ends == wanted
    padding = 0
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0, *(n for _, n in pieces)])[:-1])
        total = sum(n for _, n in pieces)
        assert total <= capacity
        padding += 0 if total & (total - 1) == 0 else capacity - total
    assert padding == 0
    # Every document of one id is put together again from its pieces.
    alone = Counter(r[0] for r in odd_rows[0])
    parts = defaultdict(list)
    for r in got:
        parts[r.doc_id].append((r.start, r.ids))
    for doc, text, *_ in odd_rows[0]:
        if alone[doc] == 1:
            assert b"".join(ids for _, ids in sorted(parts[doc])) == np.array(encoded(text), "<u4").tobytes()
    assert sum(texts.values()) == len(odd_rows[0])


def test_closest_subset_against_all_subsets():
    draw = random.Random(9)
    for _ in range(300):
        counts = Counter(draw.randrange(1, 40) for _ in range(draw.randrange(0, 9)))
        room = draw.randrange(0, 120)
        flat = list(counts.elements())
        wanted = max(t for k in range(len(flat) + 1) for c in itertools.combinations(flat, k) if (t := sum(c)) <= room)
        taken = packing.closest_subset(counts, room)
        assert sum(n * k for n, k in taken.items()) == wanted
        assert all(k <= counts[n] for n, k in taken.items())


def test_few_documents_are_cut(spark):
    """With many lengths to choose from, documents shorter than a sequence stay whole."""
    draw = random.Random(10)
    rows = [(i, " a" * draw.randrange(1, 600)) for i in range(3000)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), VOCABULARY)
    assert got.groupBy("doc_id").count().where("count > 1").count() < 30


def test_nothing_to_pack(none):
    assert packing.packed(none, VOCABULARY).count() == 0


def test_planted_facts(spark):
    """A hand-made conversation: system, user, a truncated answer, its repetition, a blank row."""
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "I am"), (1, 3, "assistant", "I am"), (1, 5, "user", " ")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = conversation_repair.verdicts(conversation_repair.rows_of(df)).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, 1, 1, 1, 7, "KKKDD")]
    assert plain.words("a b") == [b"a", b"b"]
