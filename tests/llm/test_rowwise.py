"""Quality rules, decontamination, personal data, language and toxicity."""

import random

import pytest
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import decontaminate as dc
from tessera.llm import language_id, pii_crf, quality_rules, scan, toxicity
from tessera.llm.rowwise import unpacked
from tests.conftest import ORACLE_SF
from tests.llm import brute


def test_quality_measurements(spark):
    rng = random.Random(2)
    texts = brute.ODD_TEXTS + [" ".join(rng.choice(["ab", "c|", "é", "x\n", "yy\nyy"]) for _ in range(rng.randrange(80))) for _ in range(60)]
    book = unpacked(quality_rules.ledger(brute.documents(spark, texts, extra=True)), *quality_rules.MEASURES, "failed")
    rows = {r["doc_id"]: r for r in book.collect()}
    for i, t in enumerate(texts):
        r, want = rows[i], brute.quality(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        base = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert bool(r["failed"] & quality_rules.POLICIES["base"].mask) == base
    # ablations by bits equal a recount
    got = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality_rules.ablations(book, "strict").collect()}
    mask = quality_rules.POLICIES["strict"].mask
    for rule in quality_rules.RULES:
        bit = 1 << rule.bit
        want = (sum(bool(r["failed"] & bit) for r in rows.values()), sum(r["failed"] & mask == bit for r in rows.values()))
        assert got[rule.name] == want
    kept = quality_rules.kept_rows(brute.documents(spark, texts))
    assert kept.columns == brute.documents(spark, []).columns
    assert quality_rules.kept_rows(brute.documents(spark, [])).count() == 0


def test_quality_rejects_the_labelled_junk_only(spark):
    docs, labels = (spark.read.parquet(f"{ORACLE_SF}/{t}.parquet") for t in ("documents", "labels"))
    book = quality_rules.apply_policy(quality_rules.ledger(docs))
    got = book.select("_row.doc_id", "kept", "n_words").join(labels, "doc_id").where("n_words >= 50")
    assert got.where("quality = 0 and kept").count() == 0
    assert got.where("quality = 1 and not kept").count() <= 0.01 * got.count()


def test_decontamination_matches_a_scan_of_all_windows(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"W{i}" for i in range(14)] + ["é", "x1"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(rng.choice([3, 4, 5, 9, 12]))) for i in range(8)] + [(8, None), (9, "..."), (3, line(6)), (None, "w1 w2")]
    texts = brute.ODD_TEXTS + [line(rng.randrange(90)).replace(" ", rng.choice([" ", "-", "\n. "])) for _ in range(60)]
    texts += [f"prefix, {items[0][1].upper()}! suffix"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = brute.documents(spark, texts, extra=True)
    for block in (dc.BLOCK_BYTES, 60):
        monkeypatch.setattr(dc, "BLOCK_BYTES", block)
        rows = {r["doc_id"]: r for r in unpacked(dc.decontaminate(docs, bench, window=5), "n_words", "n_hit", "items", "spans").collect()}
        for i, t in enumerate(texts):
            r = rows[i]
            assert (r["n_words"], r["n_hit"], r["items"]) == brute.benchmark_hits(t, items, 5), t
            inside = sum(len(brute.words(t[s["start"] : s["end"]], brute.ALNUM, True)) for s in r["spans"])
            assert inside == r["n_hit"]
    assert any(r["n_hit"] and not r["items"] for r in rows.values())  # hit by the item without an id alone
    monkeypatch.setattr(dc, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="bytes of text"):
        dc.decontaminate(docs, bench)
    none = bench.where("false")
    assert dc.clean_rows(docs, none).count() == len(texts)
    monkeypatch.undo()
    kept = dc.clean_rows(docs, bench, window=5)
    assert kept.columns == docs.columns and kept.count() == sum(not r["n_hit"] for r in rows.values())


def _patterns(x):
    """The four patterns, as stated."""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and pii_crf.luhn(digits):
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii_crf.KINDS.index(s[2])))


def test_base_patterns(spark):
    rng = random.Random(6)
    for _ in range(4000):
        x = "".join(rng.choice("a1.@-+ 5(_)%b09") for _ in range(rng.randrange(40)))
        assert sorted(pii_crf.pattern_spans(x)[0], key=lambda s: (s[0], pii_crf.KINDS.index(s[2]))) == _patterns(x)
    texts = brute.ODD_TEXTS + [
        "é mail a.b@c.example.org, or +1 (509) 555-6973; card 4539 1488 0343 6467 at 10.0.0.255",
        "no 999.1.1.1 nor 1234567890123456 or +12",
        "a@b.c_d@e.f " + "1" * 5000 + " " + "a@" * 500,
    ]
    rows = {r["doc_id"]: r for r in unpacked(pii_crf.pii_spans(brute.documents(spark, texts, extra=True)), "spans", "base").collect()}
    for i, t in enumerate(texts):
        base = [(s["start"], s["end"], s["kind"]) for s in rows[i]["base"]]
        assert base == _patterns(t or "")
        assert set(base) <= {(s["start"], s["end"], s["kind"]) for s in rows[i]["spans"]}


def test_crf_adds_secrets_and_leaves_plain_text_alone(spark):
    token = "1f2e3d4c5b6a79880716253443526170a1b2c3d4"
    texts = [f'with é token = "{token}" and more', "call (212) 555-0188 or write", "in 1999, 12 of 300 rooms (4%) on 2024-03-05 at 10:30", None]
    rows = {r["doc_id"]: r["spans"] for r in unpacked(pii_crf.pii_spans(brute.documents(spark, texts)), "spans").collect()}
    found = {i: [(s["kind"], texts[i][s["start"] : s["end"]]) for s in spans] for i, spans in rows.items() if texts[i]}
    assert found[0] == [("secret", token)] and found[1] == [("phone", "(212) 555-0188")] and found[2] == []
    out = {r["doc_id"]: r["text"] for r in pii_crf.masked_rows(brute.documents(spark, texts, extra=True)).collect()}
    assert out[0] == 'with é token = "<secret>" and more' and out[2] == texts[2] and not out[3]


def test_crf_recall_on_the_documents():
    import duckdb

    rows = duckdb.connect().execute(f"select text from '{ORACLE_SF}/documents.parquet'").fetchall()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows])], ["t"])
    want = found = extra = 0
    for t in scan.slices(iter([batch]), "t"):
        for text, spans in zip(t.rows.column("t").to_pylist(), pii_crf.find(t, pii_crf.train())["spans"]):
            tokens = {m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', text)}
            got = {(s["start"], s["end"]) for s in spans if s["kind"] == "secret"}
            want, found = want + len(tokens), found + len(tokens & got)
            extra += sum(not re.fullmatch("[0-9a-fA-F]{32,}", text[a:b]) for a, b in got - tokens)
    assert want > 5 and found >= 0.95 * want and extra == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{ORACLE_SF}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    model = language_id.fit(docs.where(fold != 2))
    got = unpacked(language_id.identify(docs.where(fold == 2), model, carry=("doc_id", "lang")), "lang_pred")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()
    texts = {r["lang"]: r["text"] for r in docs.where("length(text) between 800 and 3000").dropDuplicates(["lang"]).collect()}
    mixed = texts["en"] + "\n" + texts["de"]
    odd = brute.documents(spark, [None, "", "12 34 !?", "÷ €", mixed], extra=True)
    rows = {r["doc_id"]: r for r in unpacked(language_id.identify(odd, model), "lang_pred", "score", "spans").collect()}
    assert [rows[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and not rows[2]["spans"]
    langs = [s["lang"] for s in rows[4]["spans"]]
    assert langs[0] == "en" and langs[-1] == "de" and len(langs) <= 4
    turn = next(s["start"] for s in rows[4]["spans"] if s["lang"] == "de")
    assert abs(turn - len(texts["en"])) < 200
    empty = language_id.fit(docs.where("false"))
    assert {r["lang_pred"] for r in unpacked(language_id.identify(odd, empty), "lang_pred").collect()} == {"und"}


def test_scripts_narrow_the_languages(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("слово дело мир город", "ru"), ("word deal peace town", "en")] * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    probe = brute.documents(spark, ["неведомое", "unheard"])
    assert [r["lang_pred"] for r in unpacked(language_id.identify(probe, model), "lang_pred").orderBy("doc_id").collect()] == ["ru", "en"]


def test_toxicity_on_held_out_documents():
    rng = np.random.default_rng(3)
    syllables = ["the", "ation", "er", "in", "on", "at", "es", "en", "sh", "ble", "re", "ing", "ou", "nd"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    bad = ["idiot", "moron", "pathetic", "worthless", "loser", "disgusting"]

    def text(toxic):
        w = [word() for _ in range(rng.integers(40, 400))]
        for _ in range(rng.integers(4, 9) if toxic else 0):
            w[rng.integers(len(w))] = str(rng.choice(bad))
        return " ".join(w)

    y = [int(i % 4 == 0) for i in range(1600)]
    texts = [text(t) for t in y]
    model = toxicity.fit_texts(texts[:1200], y[:1200])
    h = toxicity._counts(toxicity._texts(texts[1200:]), toxicity._compressor(model.ordinary), toxicity._compressor(model.toxic))
    p, held = toxicity._scores(model, h), np.array(y[1200:])
    assert ((p >= 0.5) == held).mean() > 0.9
    assert (p[held == 1][:, None] > p[held == 0][None]).mean() > 0.95


def test_toxicity_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{ORACLE_SF}/{t}.parquet") for t in ("documents", "labels"))
    nulls = spark.createDataFrame([(None, 1, 1), (5, None, None), (6, 1, 7)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels.union(nulls))
    odd = brute.documents(spark, brute.ODD_TEXTS, extra=True)
    rows = unpacked(toxicity.score(odd, model), "score").collect()
    assert len(rows) == len(brute.ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert {r["score"] for r in unpacked(toxicity.score(odd, None), "score").collect()} == {0.0}
    assert toxicity.score(brute.documents(spark, []), model).count() == 0


def test_scripts_are_told_by_code_point():
    import unicodedata

    names = {"LATIN": "latin", "GREEK": "greek", "CYRILLIC": "cyrillic", "ARMENIAN": "armenian", "HEBREW": "hebrew", "ARABIC": "arabic",
             "DEVANAGARI": "indic", "TAMIL": "indic", "THAI": "thai_lao", "LAO": "thai_lao", "TIBETAN": "tibetan", "GEORGIAN": "georgian",
             "ETHIOPIC": "ethiopic", "HANGUL": "hangul", "HIRAGANA": "kana", "KATAKANA": "kana", "CJK UNIFIED": "han", "MYANMAR": "burmese_khmer",
             "KHMER": "burmese_khmer", "CHEROKEE": "other", "MONGOLIAN": "other"}
    wrong = []
    for point in [*range(0x41, 0x1D00), *range(0x1DC0, 0x2000), *range(0x2C00, 0xAB30), *range(0xAB70, 0xD800), *range(0xF900, 0xFFFF), 0x20000]:  # but phonetic signs
        ch = chr(point)
        name = next((n for n in names if unicodedata.name(ch, "").startswith(n + " ")), None)
        if name is None or unicodedata.category(ch) not in ("Lu", "Ll", "Lo"):
            continue
        got = language_id.scripts_of(np.frombuffer(ch.encode(), np.uint8))
        assert (got[1:] == -1).all()
        if language_id.SCRIPTS[got[0]] != names[name]:
            wrong.append((hex(point), name))
    assert wrong == []
    assert (language_id.scripts_of(np.frombuffer("12 .,-_\u2013\u201c\u3002\ue000\U0001f600\u00d7".encode(), np.uint8)) == -1).all()


def test_more_languages_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGS", 5)
    letters = "abcdefgh"
    rows = [(100 * k + i, f"{c}{c}x {c}y{c} {c}{c}{c}", f"l{c}") for k, c in enumerate(letters) for i in range(9 if k < 5 else 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.warns(UserWarning, match="5 languages"):
        model = language_id.fit(docs)
    assert model.langs == [f"l{c}" for c in letters[:5]]
    got = unpacked(language_id.identify(docs, model), "lang_pred").collect()
    assert all(r["lang_pred"] == f"l{letters[r['doc_id'] // 100]}" for r in got if r["doc_id"] < 500)
    many = spark.createDataFrame([(k, f"w{k} v{k}", f"l{k:03}") for k in range(100)], "doc_id long, text string, lang string")
    monkeypatch.undo()
    assert len(language_id.fit(many).langs) == 100


def test_two_hundred_languages_are_told_apart(spark, monkeypatch):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    pick = [[a + b + c for a, b, c in (rng.sample(letters, 3) for _ in range(12))] for _ in range(200)]
    line = lambda k, n: " ".join(rng.choice(pick[k]) for _ in range(n))
    docs = spark.createDataFrame([(k, line(k, 200), f"l{k:03}") for k in range(200)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert len(model.langs) == 200
    probe = brute.documents(spark, [line(k, 60) for k in range(200)] + [line(3, 80) + "\n" + line(150, 80), None, ""], extra=True)
    for cells in (language_id.CELLS, 200 * 500):  # also a few texts at a time
        monkeypatch.setattr(language_id, "CELLS", cells)
        rows = {r["doc_id"]: r for r in unpacked(language_id.identify(probe, model), "lang_pred", "spans").collect()}
        assert sum(rows[k]["lang_pred"] == f"l{k:03}" for k in range(200)) >= 195
        assert [s["lang"] for s in rows[200]["spans"]] == ["l003", "l150"]
        assert rows[201]["lang_pred"] == rows[202]["lang_pred"] == "und"

def test_no_labelled_documents(spark):
    docs = spark.createDataFrame([(k, f"w{k} v{k}", f"l{k % 3}") for k in range(9)], "doc_id long, text string, lang string")
    none = language_id.fit(docs.where("false"))
    assert none.langs == [] and unpacked(language_id.identify(docs.where("false"), none), "lang_pred").isEmpty()


def test_repeated_and_long_rows(spark):
    """Rows repeated under one id, under others and under none get equal results; a text of two million words passes."""
    docs, labels = (spark.read.parquet(f"{ORACLE_SF}/{t}.parquet") for t in ("documents", "labels"))
    text = max((r["text"] or "" for r in docs.limit(60).collect()), key=len) + ' mail a@b.example and token = "' + "0f1e2d3c4b" * 4 + '"'
    rows = [(i, text) for i in (1, 1, 2, None, None)] + [(7, "word " * 2_000_000)]
    odd = brute.documents(spark, rows, extra=True)
    bench = spark.createDataFrame([(1, " ".join(text.split()[:30]))], "item_id long, text string")
    lang, toxic = language_id.fit(docs), toxicity.fit(docs, labels)
    results = [
        (unpacked(quality_rules.ledger(odd), *quality_rules.MEASURES, "failed"), "n_words"),
        (unpacked(dc.decontaminate(odd, bench), "n_words", "n_hit", "items"), "n_words"),
        (unpacked(pii_crf.pii_spans(odd), "spans", "base"), None),
        (unpacked(language_id.identify(odd, lang), "lang_pred", "score", "spans"), None),
        (unpacked(toxicity.score(odd, toxic), "score", "n_windows"), None),
    ]
    for got, words in results:
        got = got.collect()
        values = [tuple(r[c] for c in r.__fields__ if c != "doc_id") for r in got if r["doc_id"] != 7]
        long = next(r for r in got if r["doc_id"] == 7)
        assert len(got) == 6 and len(values) == 5 and all(v == values[0] for v in values)
        assert words is None or long[words] == 2_000_000
    assert all(r["n_hit"] >= 30 for r in results[1][0].collect() if r["doc_id"] != 7)
    assert len(results[2][0].where("doc_id = 1").first()["spans"]) >= 2
