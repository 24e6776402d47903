"""Personal data: base patterns, and terms that give away the protected values they stand beside.

Base kinds are e-mail addresses, IP addresses, card numbers and telephone numbers, found by pattern and checked.
A found value is a protected entity.  Terms are the words of the texts that hold an entity, wherever they stand.
Over the whole corpus, with N distinct texts, n(e) that hold the entity, n(t) that hold the term and n(e, t) that
hold both, the term discloses

    ln(N n(e, t) / (n(e) n(t))) / ln(N / n(e))

of the entity's information: 1 if it occurs nowhere else, 0 if it is independent.  With a support of MIN_SUPPORT
texts or more, terms of GENERALISE or more are spans of kind ``term`` in every text that holds the entity:
generalised to their form.  Where the share is REMOVE or more they are removed, in every text that holds the term.

Most values stand in one text or two, of which no share can be estimated.  They are pooled: what values have in common
is an entity too, the domain of an e-mail address and each name in it, the network of an IP address (all but the last
number), the issuer of a card (six digits) and a telephone number without its last four digits.

* Equal texts count once, so copies alone support nothing.  Null and empty texts have no spans.
* A document row is known by doc_id and text; equal rows have equal spans.  Null ids are kept as such.
* Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .words import let, unused, words_column

KINDS = ("email", "ip", "card", "phone", "term")
MIN_SUPPORT = 3
GENERALISE, REMOVE = 0.9, 0.99
MIN_LETTERS = 3

# The patterns find what the plain ones below find, but never try a run of characters from its middle again, and
# never recurse.
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+, of 12 digits or more
#   phone  \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_PLACES = "array<struct<start:bigint,end:bigint,removed:boolean>>"
_SPAN = "array<struct<kind:int,start:bigint,end:bigint,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda p: let(part(p), lambda q: (F.char_length(q) < 4) & (F.substring(q, 1, 3).cast("int") <= 255)))
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.char_length(d) <= 19, _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.char_length(_digits(value)).between(9, 15)
    return F.lit(True)


def _starts(found: Column, pieces: Column) -> Column:
    """Where the finds begin, by the lengths of what lies between."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))

    def step(a: Column, i: Column, gaps: Column) -> Column:
        start = a["at"] + F.get(gaps, i)
        return F.struct((start + F.char_length(F.get(found, i))).alias("at"), F.concat(a["starts"], F.array(start)).alias("starts"))

    between = F.transform(pieces, lambda p: F.char_length(p).cast("long"))
    every = lambda gaps: F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, lambda a, i: step(a, i, gaps))["starts"]
    return F.when(F.size(found) > 0, let(between, every)).otherwise(F.array().cast("array<bigint>"))


def _matches(text: Column, kind: str) -> Column:
    """Checked spans of one kind."""
    pattern, code = PATTERNS[kind], KINDS.index(kind)

    def placed(found: Column) -> Column:
        span = lambda v, s: F.struct(F.lit(code).alias("kind"), s.alias("start"), (s + F.char_length(v)).alias("end"), v.alias("value"))
        spans = F.zip_with(found, _starts(found, F.split(text, pattern, -1)), span)
        return F.filter(spans, lambda s: _holds(kind, s["value"]))

    none = F.array().cast(_SPAN)
    found = let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))
    return F.when(F.contains(text, F.lit(_HINTS[kind])), found).otherwise(none) if _HINTS[kind] else found


def base_spans(text: Column) -> Column:
    """All checked spans of a text that is not null, ordered by start and kind."""
    return F.concat(*[_matches(text, k) for k in KINDS[:4]]).cast(_SPAN)


def _entities(kind: Column, value: Column) -> Column:
    """The value itself, then what it has in common with others of its kind."""
    lower, digits = F.lower(value), _digits(value)
    name, domain = F.substring_index(lower, "@", 1), F.substring_index(lower, "@", -1)
    names = F.filter(F.split(name, "[^a-z]+"), lambda n: F.char_length(n) >= MIN_LETTERS)
    common = (
        F.when(kind == 0, F.concat(F.array(F.concat(F.lit("@"), domain)), names))
        .when(kind == 1, F.array(F.substring_index(value, ".", 3)))
        .when(kind == 2, F.array(F.substring(digits, 1, 6)))
        .otherwise(F.array(F.left(digits, F.char_length(digits) - 4)))
    )
    own = F.xxhash64(kind, F.when(kind == 0, lower).otherwise(digits))
    return F.concat(F.array(own), F.transform(common, lambda c: F.xxhash64(kind, F.lit("common"), c)))


def _core(word: Column) -> Column:
    return F.regexp_replace(word, r"^\P{L}+|\P{L}+$", "")


def _terms(text: Column) -> Column:
    """The distinct terms of a text: words without what is not a letter at their ends, if only letters are left."""
    cores = F.transform(words_column(text), lambda w: F.lower(_core(w)))
    return F.array_distinct(F.filter(cores, lambda t: (F.char_length(t) >= MIN_LETTERS) & t.rlike(r"^\p{L}+$")))


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("text_key", F.xxhash64("text"))


def found_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans, terms) for every row, written; terms of texts with spans only."""
    span = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), _entities(s["kind"], s["value"]).alias("entities"))
    both = lambda spans: F.struct(spans.alias("spans"), F.when(F.size(spans) > 0, _terms(F.col("text"))).alias("terms"))
    found = let(F.transform(base_spans(F.col("text")), span), both)
    return materialize(_rows(docs).select("doc_id", "text_key", found.alias("found")), "pii-spans").select("doc_id", "text_key", "found.*")


def _placed(text: Column, terms: Column) -> Column:
    """(start, end, removed) of every word of a text that is one of the terms, an array of (term, removed)."""
    # The terms hold letters only.
    blank = r"\x20\x09-\x0D"
    names = F.array_join(terms["term"], "|")
    pattern = F.concat(F.lit(rf"(?iu)(?<![^{blank}])[^\p{{L}}{blank}]*+(?:"), names, F.lit(rf")[^\p{{L}}{blank}]*+(?![^{blank}])"))

    def placed(words: Column, starts: Column) -> Column:
        def one(w: Column, start: Column) -> Column:
            at = start + F.char_length(F.regexp_extract(w, r"^(\P{L}*)", 1))
            term = F.filter(terms, lambda t: t["term"] == F.lower(_core(w)))
            return F.struct(at.alias("start"), (at + F.char_length(_core(w))).alias("end"), F.get(term, F.lit(0))["removed"].alias("removed"))

        return F.filter(F.zip_with(words, starts, one), lambda s: s["removed"].isNotNull())

    words = F.regexp_extract_all(text, pattern, F.lit(0))
    return let(words, lambda w: let(_starts(w, F.split(text, pattern, -1)), lambda at: placed(w, at)))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text_key, terms) of the rows that hold terms to replace: an array of (start, end, removed)."""
    holders = found.where(F.size("spans") > 0).select("text_key", F.array_distinct(F.flatten("spans.entities")).alias("entities"), "terms")
    holders = materialize(holders.dropDuplicates(["text_key"]), "pii-holders")
    texts = F.lit(found.select("text_key").distinct().count()).cast("long")

    def share(n_term: Column) -> Column:
        # An entity that every text holds has no information to disclose: the share is null.
        together = texts * F.col("n_both") / (F.col("n_entity") * n_term)
        return F.try_divide(F.ln(together), F.ln(texts / F.col("n_entity")))

    mentions = holders.select("text_key", F.explode("entities").alias("entity"))
    entities = mentions.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= MIN_SUPPORT)
    mentions = materialize(mentions.join(entities, "entity"), "pii-mentions")
    together = mentions.join(holders.select("text_key", "terms"), "text_key").select("entity", "n_entity", F.explode("terms").alias("term"))
    together = together.groupBy("entity", "n_entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= MIN_SUPPORT)
    # A term is in all the texts at least in which it stands with some entity; a term that discloses too little
    # even if it is in no other text need not be looked for in the corpus.
    least = holders.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_least")).where(F.col("n_least") >= MIN_SUPPORT)
    pairs = materialize(together.join(least, "term").where(share(F.col("n_least")) >= GENERALISE).drop("n_least"), "pii-pairs")
    wanted = pairs.select("term").distinct()
    if wanted.isEmpty():
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint, terms {_PLACES}")
    # Rows of every candidate term, over all documents.
    hits = _rows(docs).select("doc_id", "text_key", F.explode(_terms(F.col("text"))).alias("term")).join(wanted, "term", "left_semi")
    hits = materialize(hits.distinct(), "pii-hits")
    terms = hits.select("text_key", "term").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    flagged = pairs.join(terms, "term").withColumn("share", share(F.col("n_term"))).where(F.col("share") >= GENERALISE)
    flagged = hits.join(flagged.select("entity", "term", (F.col("share") >= REMOVE).alias("removed")), "term")
    everywhere = flagged.where("removed")
    beside = flagged.where("NOT removed").join(mentions, ["text_key", "entity"], "left_semi").select(*everywhere.columns)
    chosen = everywhere.unionByName(beside).groupBy("doc_id", "text_key", "term").agg(F.max("removed").alias("removed"))
    chosen = chosen.groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).agg(F.collect_list(F.struct("term", "removed")).alias("chosen"))
    rows = _rows(docs).join(chosen, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")))
    return rows.select("doc_id", "text_key", _placed(F.col("text"), F.col("chosen")).cast(_PLACES).alias("terms")).dropDuplicates(["doc_id", "text_key"])


def all_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, spans) of every row: arrays of (start, kind, end, removed), ordered."""
    found = found_spans(docs)
    terms = disclosing_terms(docs, found).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), F.col("terms").alias("placed"))
    rows = found.drop("terms").join(terms, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")
    base = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("removed"))))
    apart = F.filter("placed", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"])))
    term = F.transform(apart, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("term")).alias("kind"), t["end"].alias("end"), t["removed"].alias("removed")))
    rows = rows.withColumns({"base": base, "own": term})
    every = F.when(F.col("own").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "own")))
    return rows.select("doc_id", "text_key", "base", every.alias("spans"))


def described(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts by kind, base_sha256, spans, n_term."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return all_spans(docs).select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])),
        F.sha2(described(F.col("base")), 256).alias("base_sha256"), described(F.col("spans")).alias("spans"), count(4).alias("n_term"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of their texts replaced: base values and generalised terms by their kind in
    brackets, removed terms by nothing.  Overlapping spans are replaced as one, by the first's kind."""
    d, k, own = unused(docs.columns, "d", "k", "spans")
    spans = all_spans(docs).where(F.size("spans") > 0).distinct().select(F.col("doc_id").alias(d), F.col("text_key").alias(k), F.col("spans").alias(own))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("text")

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0).cast("long")).cast("int"))
        mark = F.when(s["start"] < a["at"], F.lit("")).when(s["removed"], F.lit("")).otherwise(F.get(names, s["kind"]))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap, mark).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.char_length(text)))
    new = F.when(F.col(own).isNull(), text).otherwise(F.aggregate(own, zero, step, rest))
    same = docs["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == F.col(k))
    return docs.join(spans, same, "left").withColumn("text", new).select(*docs.columns)
