import random

from tessera.llm import license_scan as ls
from tessera.llm.license_texts import WHOLE
from tests.llm import brute

PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))


def _base(text):
    w = brute.words(text, brute.ALNUM, True)
    places = [(i, l) for l, p in PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(places), min(places, default=(None,))[0], max(places, default=(None,))[0], ",".join(sorted({l for _, l in places}))


def test_phrases_match_a_plain_search(spark):
    rng = random.Random(8)
    vocabulary = ["mit", "MIT", "license", "License", "apache", "general", "public", "the", "é", "K", "."]
    texts = brute.ODD_TEXTS + [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(80)]
    texts += ["mit-license", "MIT\nLicense.", "general public license general public license", "mİt license"]
    rows = {r["id"]: r for r in ls.scan(brute.documents(spark, texts, extra=True)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == _base(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_notices_with_edits_are_found(spark):
    bsd = next(t.text for t in ls.TEMPLATES if t.label == "bsd")
    w = bsd.split()
    texts = [
        f"Start. {bsd.title()} End.",
        "x " + " ".join(w[:8] + ["also"] + w[8:]),  # a word more: two neighbouring diagonals
        " ".join(w[:7]),  # too little of it
        "Licensed under CC BY-NC 4.0.",
        " ".join(sorted(w)),
    ]
    rows = {r["id"]: r for r in ls.scan(brute.documents(spark, texts)).collect()}
    assert [rows[i]["labels"] for i in range(5)] == ["bsd", "bsd", "", "cc-by-nc", ""]
    assert rows[0]["score"] == 1.0 and ls.LEAST_SHARE <= rows[1]["score"] < 1
    span = rows[0]["spans"][0]
    assert (span["first"], span["label"]) == (1, "bsd")


def test_a_span_is_verified_in_order(spark):
    """A notice whose parts are exchanged holds nearly all k-grams, but not in order."""
    text = "alpha one two three four beta five six seven eight gamma nine ten eleven twelve delta"
    w = text.split()
    template = (ls.Template("own", text),)
    near = w[:5] + w[7:10] + w[5:7] + w[10:]  # exchanged within the diagonals that merge
    texts = [text, " ".join(w[8:] + w[:8]), " ".join(near), " ".join(w[:9] + ["more"] + w[9:])]
    rows = {r["id"]: r for r in ls.scan(brute.documents(spark, texts), templates=template, least_share=0.1).collect()}

    def in_order(words):
        """Most k-grams met in order along one band of diagonals, by brute force."""
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        best, found = 0, [(p, grams.index(g)) for p in range(len(words) - 2) if (g := tuple(words[p : p + 3])) in grams]
        diagonals = sorted({p - t for p, t in found})
        bands, band = [], []
        for d in diagonals:
            if band and d - band[-1] > ls.NEIGHBOURS:
                bands.append(band)
                band = []
            band.append(d)
        for band in [*bands, band]:
            last, at, n = -1, -1, 0
            for p, t in sorted(x for x in found if x[0] - x[1] in band):
                if p > last and t > at:
                    last, at, n = p, t, n + 1
            best = max(best, n)
        return best / len(grams)

    for i, t in enumerate(texts):
        assert abs(rows[i]["score"] - in_order(t.split())) < 1e-12, t
    assert rows[0]["score"] == 1.0 and rows[1]["score"] < 0.7


def test_whole_licences(spark):
    """Whole texts are found as such, also as comments and with some words changed; parts and prose are not."""
    names = [label for label, _ in WHOLE]
    assert len({t for _, t in WHOLE}) == len(WHOLE) and max(len(t.split()) for _, t in WHOLE) <= 260
    rng = random.Random(9)
    comment = lambda t: "\n".join(f" * {line.upper()}" for line in t.strip().split("\n"))

    def changed(t):
        w = t.split()
        for i in rng.sample(range(len(w)), len(w) // 40):
            w[i] = rng.choice(["", "OTHER", f"{w[i]} more"])
        return " ".join(w)

    shown = [f"Copyright 2024 Somebody\n{t}\nint main() {{}}" for _, t in WHOLE]
    texts = shown + [comment(t) for _, t in WHOLE] + [changed(t) for _, t in WHOLE]
    n = len(names)
    halves = [" ".join(t.split()[: len(t.split()) // 2]) for _, t in WHOLE]
    prose = "the rights of the software and the terms of the use of this software in the public domain " * 60
    rows = ls.scan(brute.documents(spark, texts + halves + [prose, "\n".join(t for _, t in WHOLE)])).collect()
    whole = {r["id"]: {s["label"]: s["share"] for s in r["spans"] if s["whole"]} for r in rows}
    rows = {r["id"]: r for r in rows}
    for i in range(3 * n):
        own = names[i % n]
        assert set(whole[i]) == {own}, (i, whole[i])
        assert rows[i]["score"] == 1.0 if i < 2 * n else whole[i][own] >= ls.LEAST_SHARE
    span = next(s for s in rows[0]["spans"] if s["whole"])
    assert brute.words(shown[0], brute.ALNUM, True)[span["first"]] == "permission"
    assert span["last"] - span["first"] + 3 == len(brute.words(WHOLE[0][1], brute.ALNUM, True))
    assert not any(whole[i] for i in range(3 * n, 4 * n))
    assert rows[4 * n]["spans"] == [] and rows[4 * n]["score"] == 0
    assert set(whole[4 * n + 1]) == set(names)


def test_repeats_nulls_and_nothing(spark):
    rows = [(1, "mit license"), (1, "mit license"), (None, "apache license")]
    got = sorted((str(r["id"]), r["labels"], r["n_base"]) for r in ls.scan(brute.documents(spark, rows)).collect())
    assert got == [("1", "mit", 1), ("1", "mit", 1), ("None", "apache", 1)]
    assert ls.scan(brute.documents(spark, [])).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = ls.scan(brute.documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
