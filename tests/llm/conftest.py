from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tellerframe.llm import blocks, lm_scoring

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names the operators use themselves, and names of other tables.
CLASHES = (
    "block", "words", "score", "size", "target", "copies", "taken", "token", "item_id", "spans", "_row", "_key", "_d", "component", "bucket",
    "text_key", "label", "shard", "_quality", "is_trusted", "range", "turn",
)


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Blocks of 16 KB, so that small tables have many."""
    monkeypatch.setattr(blocks.deal, "__defaults__", (16 << 10,))
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 16 << 10)


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, ties, repeats, copies, near copies, shared passages, personal data and long texts."""
    draw = random.Random(7)
    vocabulary = [a + b for a in ("the", "re", "on", "ti", "Ä", "sch", "ou") for b in ("", "an", "er", "st", "é", "LY", "ing,", ".")]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    passage, item, original = say(60), say(40), say(120)
    rows = [(i, say(draw.randrange(5, 200)).replace(" ", draw.choice([" ", "  ", "\n", "\t"]), 3), draw.choice(["en", "de"]), f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, say(30) + "\n" + passage + " " + say(30), "en", "hot") for i in range(12)]
    rows += [(200 + i, original, "de", "hot") for i in range(8)]
    near = original.split()
    for i in range(12):
        w = list(near)
        for k in draw.sample(range(len(w)), 1 + i % 5):
            w[k] = f"changed{i}"
        rows.append((300 + i, " ".join(w).upper() if i == 3 else " ".join(w), "de", "hot"))
    rows += [(400, say(20) + " " + item + " " + say(3000), "en", "long"), (401, item, "en", "é"), (402, item[:60], "en", "é")]
    rows += [(500, None, None, None), (501, "", "en", None), (502, " \n\t ", "en", "s1"), (503, "one", None, "s2"), (504, "One", "en", "s2"),
             (505, "a b c d", "en", "s3"), (506, "A b c  d", "en", "s3"), (507, "1234 5678 +++", "en", "s3"), (508, "ha " * 400, "en", "s3")]
    rows += [(600, say(80), "en", "s1")] * 3 + [(601, say(80), "en", "s1"), (601, say(90), "de", "s1"), (None, say(70), "en", "s1"), (None, original, "de", "s1")]
    for i in range(5):
        rows.append((700 + i, f"{say(20)} Zebulon mail.{i % 2}@host{i % 2}.example.com, {say(20)} 10.0.0.{i} 256.1.1.1 or 4111 1111 1111 1111 or +1 (555) 010-{9990 + i} and {'7' * 30}", "en", "s0"))
    rows.append((710, "a@b.c_d@e.f x@y 1.2.3.4.5.6.7.8 +1 2 411111111111111111111111 4111-1111-1111-1111-" + "9" * 40, "en", "s0"))
    return rows, item


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(*r, None if r[1] is None else len(r[1])) for r in odd_rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return docs.withColumns({c: F.lit("x") for c in CLASHES}).cache()


@pytest.fixture(scope="session")
def none(spark, odd_docs):
    """No rows, the same columns."""
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def odd_items(spark, odd_rows):
    item = odd_rows[1]
    rows = [(1, item), (2, "a B c d"), (3, None), (4, ""), (None, item[:100]), (5, "words that are in no document at all, or so we hope"), (1, item)]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("doc_id", F.lit(1))


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, int(i % 3 > 0), 0) for i in range(60)] + [(1, 0, 0), (None, 1, 0), (2, None, 1), (99999, 1, 0), (500, 0, 0), (501, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("clash"))
