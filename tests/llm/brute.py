"""Plain Python versions of the operators' base results, and small fixtures."""

import re
from collections import Counter

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=False):
    """A documents table; (id, text) pairs keep their id. ``extra`` adds columns with clashing names."""
    rows = []
    for i, t in enumerate(texts):
        i, t = t if isinstance(t, tuple) else (i, t)
        rows.append((i, t, None, None, None if t is None else len(t)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        for name in ("_row", "_text", "node", "kept", "spans", "n_words", "failed", "t", "first", "length", "token"):
            df = df.withColumn(name, F.lit("x"))
    return df


ODD_TEXTS = [None, "", " \n\t ", "one", "Zwei drei", "a " * 3000, "é" * 70, "x" * 400, "same text here now", "same text here now"]


def words(text, pattern=PLAIN, lower=False):
    text = text or ""
    return pattern.findall(text.translate(LOWER) if lower else text)


def shingles(text, n):
    w = words(text, lower=True)
    if 0 < len(w) < n:
        return {tuple(w)}
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(ids, linked):
    """Smallest reachable id per id."""
    part = {i: i for i in ids}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_groups(texts, n, num, den):
    sets = {i: shingles(t, n) for i, t in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, components(sets, links)


def quality(text):
    text = text or ""
    w, lines, seen, dup = words(text), text.split("\n"), set(), 0
    for line in lines:
        if PLAIN.search(line):
            dup += line in seen
            seen.add(line)
    count, hit = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if count[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def benchmark_hits(text, items, n):
    """(words, hit words, sorted item ids)."""
    w, hit, found = words(text, ALNUM, True), set(), set()
    for item, t in items:
        q = words(t, ALNUM, True)
        size = min(n, len(q))
        for a in range(len(q) - size + 1 if size else 0):
            for b in range(len(w) - size + 1):
                if w[b : b + size] == q[a : a + size]:
                    hit |= set(range(b, b + size))
                    if item is not None:  # an item without an id hits, but is not listed
                        found.add(str(item))
    return len(w), len(hit), sorted(found)


def removed(rows, length=50):
    """{id: bytes kept} after removing strings that start in a smaller id."""
    out = {}
    for i, t in rows:
        raw, cover = (t or "").encode(), set()
        smaller = {x[s : s + length] for j, u in rows if j < i for x in [(u or "").encode()] for s in range(len(x) - length + 1)}
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in smaller:
                cover |= set(range(s, s + length))
        out[i] = (raw, cover)
    return out
