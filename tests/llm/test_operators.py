"""Every operator on odd rows against its plain version, and on no rows at all."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tellerframe.llm import blocks, decontamination, jaccard_join, language_id, lm_scoring, mixing, pii, quality_classifier, quality_rules, substring_dedup, suffix_dedup

from . import plain


def pairs(odd_rows):
    return [(r[0], r[1]) for r in odd_rows[0]]


def same(df, expected):
    assert Counter(tuple(r) for r in df.collect()) == Counter(expected)


@pytest.mark.parametrize("doublings", [1, 2])
def test_substring_dedup(odd_docs, odd_rows, doublings):
    got = substring_dedup.repeated_words(odd_docs, 20, doublings)
    same(got.drop("removed"), plain.substring_dedup(pairs(odd_rows)))
    for r in got.where("n_removed > 0").collect():
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_substring_dedup_needs_whole_levels(odd_docs):
    with pytest.raises(ValueError):
        substring_dedup.repeated_words(odd_docs, 20, 3)


def test_jaccard_join(odd_docs, odd_rows):
    same(jaccard_join.linked(odd_docs), plain.jaccard_components(pairs(odd_rows)))


def test_repeated_passages(odd_docs, odd_rows):
    """Every document is covered by its own rows, up to the last word."""
    rows = pairs(odd_rows)
    true = {}
    for (doc, _), own in zip(rows, plain.repeated_places(rows)):
        true.setdefault(doc, set()).update(own)
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(plain.words(text))
    covered = {doc: set() for doc in true}
    for r in suffix_dedup.repeated_passages(odd_docs).collect():
        one = {tuple(w[r.start : r.start + r.n_words]) for w in texts[r.doc_id]}
        two = {tuple(w[r.other_start : r.other_start + r.n_words]) for w in texts[r.other_doc_id]}
        assert any(len(t) == r.n_words >= 50 for t in one & two)
        assert not r.within or r.doc_id == r.other_doc_id
        covered[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert covered == true


def test_passages_across_documents(odd_docs, odd_rows):
    """Documents that share 50 words with another one, and no document that only repeats itself."""
    rows = pairs(odd_rows)
    holders = {}
    for n, (_, text) in enumerate(rows):
        w = plain.words(text)
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i : i + 50]), set()).add(n)
    true = {rows[n][0] for found in holders.values() if len(found) > 1 for n in found}
    assert 508 not in true
    got = suffix_dedup.repeated_passages(odd_docs)
    assert {r.doc_id for r in got.where("NOT within").collect()} == true
    assert got.where("within AND doc_id = 508").count() > 0


def test_passages_beside_a_hot_clause(spark):
    """A clause of 40 words that every document holds hides no longer passage that a few of them share."""
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    clause = say(40)
    rows = [(i, f"{say(30)} {clause} {say(30)}") for i in range(300)]
    for i in range(0, 300, 3):  # pairs with 10 or more words in common, before the clause, behind it or on both sides
        before = draw.randrange(0, 11)
        left, right = say(before), say(10 - before + i % 4)
        rows[i : i + 2] = [(n, f"{say(25)} {left} {clause} {right} {say(25)}") for n in (i, i + 1)]
    true = plain.repeated_places(rows)
    assert sum(map(bool, true)) >= 200
    covered = [set() for _ in rows]
    for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect():
        covered[r.doc_id].update(range(r.start, r.start + r.n_words))
    assert covered == true


def test_rows_of_one_doc_id_are_spread_over_blocks(spark):
    """Rows without doc_id, and rows of a repeated one, are as many in a block as others."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * 50) for i in range(1200)]
    dealt = blocks.deal(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sizes = [r["count"] for r in dealt.frame.groupBy("block").count().collect()]
    assert len(sizes) == dealt.n_ranges > 20 and max(sizes) < 3 * 1200 / len(sizes)


def test_short_passages_are_refused(odd_docs):
    with pytest.raises(ValueError):
        suffix_dedup.repeated_passages(odd_docs, 30)


def test_quality_rules(odd_docs, odd_rows, odd_labels):
    got = quality_rules.judged(odd_docs, odd_labels.where("quality = 1"))
    base = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    same(base, [(doc, *plain.base_rules(text)) for doc, text in pairs(odd_rows)])
    assert got.where("kept AND (base_failed OR mean_ratio IS NULL)").count() == 0
    assert got.where("n_words = 0 AND mean_ratio IS NOT NULL").count() == 0


def test_quality_ratio(spark, odd_rows, odd_labels):
    """The mean over unigrams and bigrams of the logarithm of the two shares, the trusted one without the text's own fold,
    from the buckets themselves; and the threshold from the trusted rows."""
    docs = spark.createDataFrame(pairs(odd_rows), "doc_id bigint, text string").where("doc_id < 60")
    trusted = {r.doc_id for r in odd_labels.where("quality = 1").collect()}
    columns = quality_rules.grams_column(quality_rules.words_column("text"), 64), quality_rules.fold_column(F.col("text"), 3)
    rows = [(r.doc_id, r.g or [], r.f) for r in docs.select("doc_id", columns[0].alias("g"), columns[1].alias("f")).collect()]
    raw = Counter(b for _, g, _ in rows for b in g)
    ratio = {}
    for fold in range(3):
        target = Counter(b for d, g, f in rows if d in trusted and f != fold for b in g)
        for b in range(64):
            share = (raw[b] + 1) / (sum(raw.values()) + 64)
            smooth = (target[b] + quality_rules.SMOOTHING * share) / (sum(target.values()) + quality_rules.SMOOTHING)
            ratio[fold, b] = math.log(smooth / share)
    wanted = sorted((d, round(sum(ratio[f, b] for b in g) / len(g), 4)) for d, g, f in rows if g)
    got = quality_rules.judged(docs, odd_labels.where("quality = 1"), buckets=64, folds=3, keep_percent=80).collect()
    assert [d for d, _ in wanted] == sorted(r.doc_id for r in got if r.mean_ratio is not None)
    found = sorted((r.doc_id, round(r.mean_ratio, 4)) for r in got if r.mean_ratio is not None)
    assert all(a[1] == pytest.approx(b[1], abs=2e-4) for a, b in zip(found, wanted))
    passed = sorted((r.mean_ratio for r in got if r.doc_id in trusted and not r.base_failed), reverse=True)
    line = math.floor(passed[math.ceil(0.8 * len(passed)) - 1] * 10_000) / 10_000
    assert all(r.kept == (r.mean_ratio >= line) for r in got if not r.base_failed and r.mean_ratio is not None)


def test_gram_counts_hash_a_text_once(spark, odd_rows, odd_labels):
    """A row for each bucket, not for each fold and bucket, with plain counts; the n-grams' expression hashes no whole text."""
    docs = spark.createDataFrame(pairs(odd_rows), "doc_id bigint, text string").where("doc_id < 60")
    trusted = {r.doc_id for r in odd_labels.where("quality = 1").collect()}
    columns = quality_rules.grams_column(quality_rules.words_column("text"), 64), quality_rules.fold_column(F.col("text"), 3)
    rows = [(r.doc_id, r.g or [], r.f) for r in docs.select("doc_id", columns[0].alias("g"), columns[1].alias("f")).collect()]
    raw = Counter(b for _, g, _ in rows for b in g)
    own = Counter((b, f) for d, g, f in rows if d in trusted for b in g)
    got = quality_rules.gram_counts(docs, odd_labels.where("quality = 1"), buckets=64, folds=3)
    assert sorted(map(tuple, got.collect())) == sorted((b, n, own[b, 0], own[b, 1], own[b, 2]) for b, n in raw.items())
    _, explode = got._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")
    explode = explode.split("Join")[0]
    assert "xxhash64(lambda" in explode and "xxhash64(text" not in explode


def test_quality_verdicts_hold_for_unseen_documents(spark):
    """Trusted are half of the documents labelled good: of the other half nine in ten stay in every language, and most bad
    ones go.  Without trusted texts the base rules alone decide."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = labels.where("quality = 1 AND crc32(CAST(doc_id AS STRING)) % 2 = 0")
    got = quality_rules.judged(docs, half).where("NOT base_failed").join(docs.select("doc_id", "lang"), "doc_id")
    rest = got.join(labels, "doc_id").join(half, "doc_id", "left_anti")
    shares = {(r.lang, r.quality): r.kept for r in rest.groupBy("lang", "quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    print(shares)
    assert all(share >= 0.9 for (lang, good), share in shares.items() if good == 1)
    assert all(share <= 0.25 for (lang, good), share in shares.items() if good == 0)
    few = docs.limit(50)
    assert quality_rules.judged(few, half.where("false")).where("kept = base_failed").isEmpty()


def test_grams_are_the_texts_own(spark):
    row = spark.sql("SELECT array('a', 'b', 'c') AS w").select(quality_rules.grams_column(F.col("w"), 1 << 20).alias("g")).first()
    wanted = spark.sql("SELECT pmod(xxhash64('a'), 1048576) a, pmod(xxhash64('b'), 1048576) b, pmod(xxhash64('c'), 1048576) c, pmod(xxhash64('a', 'b'), 1048576) ab, pmod(xxhash64('b', 'c'), 1048576) bc").first()
    assert row.g == list(wanted)


def test_classifier_scores_all_rows(odd_docs, odd_labels, odd_rows):
    got = quality_classifier.predicted_quality(odd_docs, odd_labels)
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows[0])
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and plain.crc(r.doc_id, 3) == 1) for r in rows)


def test_classifier_without_labels(odd_docs, odd_labels):
    got = quality_classifier.predicted_quality(odd_docs, odd_labels.where("false"))
    assert {r.score for r in got.collect()} == {0.5}


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.predicted_quality(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.predicted_language(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_language_of_odd_rows(odd_docs, odd_rows):
    rows = language_id.predicted_language(odd_docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows[0])
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und") for r in rows)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {500, 501, 502, 507}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 12])
def test_codewords_differ(n):
    codes = language_id.codewords(n)
    apart = [(codes[a] != codes[b]).sum() for a in range(n) for b in range(a)]
    assert len(codes) == n and (not apart or min(apart) >= max(1, codes.shape[1] // 4))


def test_one_language_or_none(odd_docs):
    one = language_id.predicted_language(odd_docs.where("lang = 'en'"))
    assert {r.lang_pred for r in one.collect()} == {"en", "und"}
    unknown = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.predicted_language(unknown).collect()} == {"und"}


def test_lm_scores(odd_docs, odd_rows):
    rows = [(doc, plain.words(text)) for doc, text in pairs(odd_rows)]
    counts = Counter(tuple(w[i : i + n]) for _, w in rows for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(len(w) for _, w in rows)

    def value(run):
        if len(run) == 1:
            return math.log(counts[run]) - math.log(total)
        return math.log(counts[run]) - math.log(counts[run[:-1]]) if counts[run] >= 2 else math.log(0.4) + value(run[1:])

    expected = Counter()
    for doc, w in rows:
        score = sum(value(tuple(w[max(0, i - 2) : i + 1])) for i in range(len(w)))
        expected[doc, len(w), round(score, 6)] += 1
    got = lm_scoring.stupid_backoff(odd_docs).collect()
    assert Counter((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0) for r in got) == expected
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)


def test_personal_data(odd_docs, odd_rows):
    got = pii.personal_data(odd_docs).collect()
    expected, found = Counter(), Counter()
    for doc, text in pairs(odd_rows):
        spans = plain.personal_data(text)
        kinds = Counter(k for k, _, _ in spans)
        expected[doc, *(kinds[k] for k in plain.PATTERNS), hashlib.sha256(plain.described(spans).encode()).hexdigest()] += 1
    for r in got:
        found[r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256] += 1
        kept = ",".join(s for s in r.spans.split(",") if not s.startswith("term:"))
        assert hashlib.sha256(kept.encode()).hexdigest() == r.base_sha256
    assert found == expected


def test_disclosing_terms(spark):
    """A name that stands beside one address only, in three texts, gives it away; a common word does not."""
    rows = [(i, f"note {i} from Zebulon <zeb@example.com> about the weather {i * 7}") for i in range(3)]
    rows += [(10 + i, f"the weather about number {i} is a note from no one") for i in range(20)]
    rows += [(40, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i in (0, 1, 2, 40):
        start = got[i].spans.split(",")
        text = dict(rows)[i]
        terms = {text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in start if s.startswith("term:")}
        assert terms == {"Zebulon"}
    assert all(got[10 + i].spans == "" for i in range(20))
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[0] == "note 0 from  <[EMAIL]> about the weather 0" and clean[12] == dict(rows)[12]


def test_disclosing_terms_far_from_the_entity(spark):
    """A name that gives an address away goes wherever it stands: far behind the address, and in a text without it."""
    far = "the weather is a matter of note " * 6
    rows = [(i, f"number {i} of <zeb@example.com> {far}and ZEBULON, {far}(Zebulon) again") for i in range(3)]
    rows += [(10 + i, f"number {i} {far}and again") for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, "of number 77 (Zebulon)")], "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[1] == f"number 1 of <[EMAIL]> {far}and [TERM], {far}([TERM]) again" and clean[15] == rows[8][1] and clean[None] == "of number 77 (Zebulon)"
    clean = {r.doc_id: r.text for r in pii.sanitised(docs.where("doc_id IS NOT NULL OR text IS NULL")).collect()}
    assert clean[1] == f"number 1 of <[EMAIL]> {far}and , {far}() again"
    # 200 texts in which they stand together, one without the address: a share of 0.999.
    many = [(i, f"number {i} of <zeb@example.com> {far}and Zebulon") for i in range(200)] + [(1000 + i, f"number {i} {far}and again of") for i in range(20000)]
    docs = spark.createDataFrame([*many, (None, "of number 77 (Zebulon)")], "doc_id bigint, text string")
    assert pii.sanitised(docs).where("doc_id IS NULL").first().text == "of number 77 ()"


def test_disclosing_terms_of_values_in_one_text(spark):
    """Addresses of one text each: what they have in common is disclosed, a word beside one of them is not."""
    rows = [(i, f"number {i} {w} from <zebulon.{w}@acme{i}.example> about the weather") for i, w in enumerate(("ash", "oak", "elm"))]
    rows += [(5 + i, f"number {i} {w} from Acmeworks {w}@acme.example, 10.1.1.{i} about the weather") for i, w in enumerate(("ida", "uma", "eva"))]
    rows += [(10 + i, f"the weather about number {i} is a note from no one") for i in range(60)]
    rows += [(80 + i, f"number {i} {w} {i} Zebulon <zebulon{i}@x{i}.example>") for i, w in enumerate(("fir", "yew", "bay"))]
    clean = {r.doc_id: r.text for r in pii.sanitised(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert clean[5] == "number 0 ida from  [EMAIL], [IP] about the weather" and clean[0] == "number 0 ash from <[EMAIL]> about the weather"
    assert "Zebulon" not in clean[80] and clean[12] == rows[8][1]


def test_sanitised_keeps_the_rest(odd_docs, odd_rows):
    got = pii.sanitised(odd_docs)
    assert got.columns == odd_docs.columns
    texts = Counter((r.doc_id, r.text) for r in got.collect())
    clean = Counter((doc, text) for doc, text in pairs(odd_rows) if not plain.personal_data(text))
    assert sum(texts.values()) == len(odd_rows[0]) and clean - texts == Counter()
    marked = next(t for (d, t) in texts if d == 700)
    assert marked.count("[EMAIL]") == 1 and marked.count("[CARD]") == 1 and "555" not in marked and "256.1.1.1" in marked


def test_long_texts_do_not_recurse(spark):
    docs = spark.createDataFrame([(1, "1 " * 200_000), (2, "a." * 200_000), (3, "+" + "1" * 200_000), (4, "x@" + "y." * 100_000)], "doc_id bigint, text string")
    assert pii.personal_data(docs).where("n_card + n_phone > 0").count() == 0


def test_decontamination(odd_docs, odd_rows, odd_items):
    items = [(r.item_id, r.text) for r in odd_items.collect()]
    got = decontamination.contaminated(odd_docs, odd_items).select("doc_id", "item_id", "n_item_shingles", "n_shared")
    same(got, plain.containment(pairs(odd_rows), items))
    kept = Counter(r.doc_id for r in decontamination.clean(odd_docs, odd_items).collect())
    held = {d for d, *_ in plain.containment(pairs(odd_rows), items)}
    assert {400, 401, 505, 506} <= held and kept == Counter(d for d, _ in pairs(odd_rows) if d not in held)


def test_only_candidates_are_made_distinct(odd_docs, odd_items):
    """Equal rows are sought among the documents that may hold an item, not among all texts."""
    plan = decontamination.contaminated(odd_docs, odd_items)._jdf.queryExecution().optimizedPlan().toString()
    texts = next(part for part in plan.split("Aggregate [")[1:] if "text#" in part.split("]")[0])
    assert "LeftSemi" in texts


def test_decontamination_in_blocks(odd_docs, odd_rows, odd_items, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 10)
    items = [(r.item_id, r.text) for r in odd_items.collect()]
    got = decontamination.contaminated(odd_docs, odd_items).select("doc_id", "item_id", "n_item_shingles", "n_shared")
    same(got, plain.containment(pairs(odd_rows), items))


def test_curriculum(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_GROUP", 3)
    rows = odd_docs.select("doc_id", "source", mixing.size_column().alias("size"), "taken", "block")
    got = mixing.curriculum(rows).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows[0])
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies)
    targets = {r.source: r.target for r in got}
    total = sum(sizes.values())
    assert sum(targets.values()) == pytest.approx(total)
    for s, n in sizes.items():
        assert taken[s] == int(targets[s]) <= 3 * n
    # The plain way: cap what is above, share the rest again.
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order if s not in capped}
        above = {s for s in share if share[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    assert targets == pytest.approx({**{s: 3 * sizes[s] for s in capped}, **share})
    first = [r.copies[0].position for r in got if r.copies]
    assert first == sorted(first) and [r.taken > 0 for r in got] == sorted((r.taken > 0 for r in got), reverse=True)


@pytest.mark.parametrize("knots", [((0, 1.5), (1, 0.5)), ((0, 1), (1, 1)), ((0, 0), (0.25, 2), (1, 0.5))])
def test_inverted_schedule(spark, knots):
    """The integral up to the time found is the share asked for."""

    def integral(t):
        done = 0.0
        for (a, v), (b, w) in zip(knots, knots[1:]):
            x = min(max(t - a, 0), b - a)
            done += v * x + (w - v) / (b - a) * x * x / 2
        return done

    rows = spark.range(101).select((F.col("id") / 100).alias("y")).select("y", mixing.when_demanded(F.col("y"), knots).alias("t")).collect()
    for r in rows:
        assert integral(r.t) == pytest.approx(r.y * integral(1), abs=1e-9)


def test_no_rows(none, odd_items, odd_labels):
    assert substring_dedup.repeated_words(none).count() == 0
    assert jaccard_join.linked(none).count() == 0
    assert suffix_dedup.repeated_passages(none).count() == 0
    assert quality_rules.judged(none, odd_labels).count() == 0
    assert quality_classifier.predicted_quality(none, odd_labels).count() == 0
    assert language_id.predicted_language(none).count() == 0
    assert lm_scoring.stupid_backoff(none).count() == 0
    assert pii.personal_data(none).count() == 0
    assert pii.sanitised(none).count() == 0
    assert decontamination.contaminated(none, odd_items).count() == 0
    assert decontamination.clean(none, odd_items).count() == 0
    assert mixing.curriculum(none.select("doc_id", "source", F.lit(1).cast("long").alias("size"))).count() == 0


def test_no_items(odd_docs, odd_items):
    assert decontamination.clean(odd_docs, odd_items.where("false")).count() == odd_docs.count()
