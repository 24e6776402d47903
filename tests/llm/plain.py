"""Plain versions of the training-data operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text):
    return WORD.findall((text or "").encode())


def last_if_null(doc_id):
    return (doc_id is None, doc_id or 0)


def substring_dedup(rows, length=20):
    """(n_words, n_removed, digest) of rows (doc_id, text)."""
    first = {}
    for n, (doc, text) in enumerate(rows):
        w = words(text)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, ((True, 1),)), (last_if_null(doc),))
    result = []
    for doc, text in rows:
        w, own = words(text), set()
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if key in own or first[key][0] < last_if_null(doc):
                gone[i : i + length] = [True] * length
            own.add(key)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        result.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return result


def shingles(text, n=5):
    w = words((text or "").encode().translate(LOWER).decode())
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def jaccard_components(rows, percent=75):
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in sets if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for n, (doc, own) in enumerate(sets):
        for s in own:
            holders[s].append(n)
    for n, (doc, own) in enumerate(sets):
        common = Counter(m for s in own for m in holders[s] if m < n)
        for m, shared in common.items():
            other, theirs = sets[m]
            if None not in (doc, other) and 100 * shared >= percent * (len(own) + len(theirs) - shared):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
    return [(doc, len(own), None if doc is None else root(doc)) for doc, own in sets]


def base_rules(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, digits[::-1]))) % 10 == 0


def personal_data(text):
    """(kind, start, end) by start and kind."""
    found = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), n, m.end(), kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def described(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def crc(doc_id, share):
    return zlib.crc32(str(doc_id).encode()) % share


def containment(docs, items, percent=75):
    lowered = lambda t: (t or "").lower()
    sets = {}
    for item, text in items:
        sets.setdefault(item, set()).update(shingles(lowered(text)))
    found = set()
    for doc, text in set(docs):
        own = shingles(lowered(text))
        for item, theirs in sets.items():
            if theirs and 100 * len(own & theirs) >= percent * len(theirs):
                found.add((doc, item, len(theirs), len(own & theirs)))
    return sorted(found, key=str)


def repeated_places(rows, length=50):
    """Words of each row that lie in a window of ``length`` words which occurs elsewhere too."""
    places = defaultdict(list)
    texts = [words(text) for _, text in rows]
    for n, w in enumerate(texts):
        for i in range(len(w) - length + 1):
            places[tuple(w[i : i + length])].append((n, i))
    covered = [set() for _ in rows]
    for found in places.values():
        if len(found) > 1:
            for n, i in found:
                covered[n].update(range(i, i + length))
    return covered
