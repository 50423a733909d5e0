"""The pipeline against a plain version of its stages."""

import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from tessera.llm import pii_crf, quality_rules, scan
from tessera.llm.session import tokenizer_path
from tests.conftest import SMALL_SF
from tests.llm import brute


def _plain(docs, items):
    """{doc_id: text} that reaches packing."""
    out = {}
    for i, t in docs.items():
        n, _, symbols, dup, repeat = brute.quality(t)
        lines = sum(bool(brute.PLAIN.search(x)) for x in t.split("\n"))
        if n < 50 or 100 * repeat > 50 * n or 100 * symbols > 30 * n or (100 * dup > 50 * lines and lines >= 4):
            continue
        out[i] = t
    _, groups = brute.jaccard_groups(out, 5, 8, 10)
    out = {i: t for i, t in out.items() if groups[i] == i}
    grams = {tuple(w[a : a + 10]) for w in (brute.words(t, brute.ALNUM, True) for t in items) for a in range(max(1, len(w) - 9))}
    clean = {}
    for i, t in out.items():
        w = brute.words(t, brute.ALNUM, True)
        if not any(tuple(w[a : a + 10]) in grams for a in range(len(w))):
            raw = t.encode()
            slice_ = scan.Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), None)
            clean[i] = pii_crf.masked(t, pii_crf.find(slice_, pii_crf.train())["spans"][0])
    return clean


def test_matches_the_plain_version(spark):
    from tokenizers import Tokenizer

    rows = cp.run(spark, SMALL_SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL_SF}/benchmark.parquet").collect()]
    assert all(len(brute.words(t, brute.ALNUM, True)) >= 10 for t in items)
    want = _plain(docs, items)
    t = Tokenizer.from_file(tokenizer_path())
    pieces = defaultdict(dict)
    for r in rows:
        pieces[r["doc_id"]][r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    assert set(pieces) == set(want)
    for i, text in want.items():
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [1], "<u4")
        cuts = [ids[a : a + 4096] for a in range(0, len(ids), 4096)]
        assert pieces[i] == {p: (p * 4096, len(c), zlib.crc32(c)) for p, c in enumerate(cuts)}


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    ready = "word number %d stands here with several others in a row and more follow it soon, "
    long = "".join(ready % i for i in range(12))
    rows = [(None, long), (3, long), (3, long), (5, None), (None, None), (6, ""), (7, long + " ask (212) 555-0188")]
    docs = brute.documents(spark, rows, extra=True)
    for docs in (docs, docs.where(F.lit(False))):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SMALL_SF)
            assert out.columns == docs.columns, name
            docs = out.checkpoint()
        cp.STAGES[-1][1](spark, docs, SMALL_SF).count()


def test_near_duplicates_judge_rows_not_ids(spark):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(120))
    a, b, c, d, e = (text() for _ in range(5))
    near = b.replace(b.split()[50], "other", 1)
    assert len(brute.shingles(b, 5) & brute.shingles(near, 5)) * 10 >= 8 * len(brute.shingles(b, 5) | brute.shingles(near, 5))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, near), (4, d), (4, d), (4, d + " "), (None, e), (None, e), (None, a), (None, ""), (5, None)]
    out = cp.near_duplicates(spark, brute.documents(spark, rows, extra=True), SMALL_SF).collect()
    got = sorted((str(r["doc_id"]), (r["text"] or "").strip()) for r in out)
    want = [("1", a), ("2", b), ("3", c), ("4", d), ("None", e), ("None", ""), ("5", "")]
    assert got == sorted(want)


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert [name for name, _ in cp.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "personal_data", "bestfit_packing"]
    assert quality_rules.POLICIES[quality_rules.DEFAULT_POLICY].mask & 3 == 3
