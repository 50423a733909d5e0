import random

from tessera.llm import jaccard_join as jj
from tests.llm import brute


def _check(df, texts, n, num, den):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jj.jaccard_components(df, n, num, den).collect()}
    sizes, groups = brute.jaccard_groups(texts, n, num, den)
    assert got == {i: (sizes[i], groups[i]) for i in texts}


def _copies(rng, vocabulary, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


def test_matches_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 7)  # several blocks for the long lists here
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = list(brute.ODD_TEXTS)
    for size, n, edits in ((60, 40, 6), (25, 15, 2), (8, 12, 2), (200, 6, 9)):
        texts += _copies(rng, vocabulary, [rng.choice(vocabulary) for _ in range(size)], n, edits)
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(40)]
    texts += texts[12:20]  # exact copies
    df = brute.documents(spark, texts, extra=True)
    texts = dict(enumerate(texts))
    _check(df, texts, 3, 90, 100)
    _check(df, texts, 5, 8, 10)


def test_nulls_repeats_and_nothing(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, None), (9, None), (None, "alone here now")]
    got = jj.jaccard_components(brute.documents(spark, rows), 3, 90, 100).collect()
    assert sorted(str(r["component_id"]) for r in got) == ["2", "2", "2", "2", "9", "None", "None"]
    assert jj.jaccard_components(brute.documents(spark, []), 3, 90, 100).count() == 0


def test_links_are_counted_per_class(spark):
    base = [f"w{i}" for i in range(100)]
    near = base[:50] + ["x"] + base[51:]
    df = brute.documents(spark, [" ".join(base), " ".join(near), " ".join(base), "other words stand here"])
    got = {r["doc_id"]: r["n_links"] for r in jj.jaccard_components(df, 3, 90, 100).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 0}


def test_links_within_a_group_are_all_counted(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 7)
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    texts = dict(enumerate(dict.fromkeys(_copies(rng, vocabulary, base, 40, 1) + _copies(rng, vocabulary, base[:45], 30, 1))))
    assert len(texts) > 4 * jj.SHORT_LIST
    sets = {i: brute.shingles(t, 3) for i, t in texts.items()}
    linked = lambda x, y: 100 * len(x & y) >= 90 * len(x | y)
    want = {i: sum(linked(x, y) for j, y in sets.items() if j != i) for i, x in sets.items()}
    df = brute.documents(spark, [texts[i] for i in sorted(texts)])
    got = jj.jaccard_components(df, 3, 90, 100).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == want
    alone = jj.jaccard_components(df, 3, 90, 100, count_links=False)
    assert alone.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(alone.collect()) == sorted(r[:3] for r in got)


def test_links_through_rows_without_an_id(spark):
    """Ids 1 and 2 link to a text without an id, not to each other."""
    w = [f"w{i}" for i in range(400)]
    a, b = w[:200] + w[220:], w[:100] + w[120:]
    rows = [(1, " ".join(a)), (None, " ".join(w)), (2, " ".join(b)), (None, " ".join(w)), (None, "quite another text stands here")]
    linked = lambda x, y: 10 * len(x & y) >= 9 * len(x | y)
    x, y, z = (brute.shingles(" ".join(t), 3) for t in (a, w, b))
    assert linked(x, y) and linked(y, z) and not linked(x, z)
    for links in (True, False):
        got = jj.jaccard_components(brute.documents(spark, rows), 3, 90, 100, count_links=links).collect()
        assert sorted(str(r["component_id"]) for r in got) == ["1", "1", "1", "1", "None"]
    got = jj.jaccard_components(brute.documents(spark, [(None, t) for _, t in rows]), 3, 90, 100, with_class=True).collect()
    assert sorted(r["n_links"] for r in got) == [0, 1, 1, 2, 2] and len({r["component"] for r in got}) == 2
    assert {r["component_id"] for r in got} == {None}


def test_every_pair_is_verified_once(spark, monkeypatch):
    """What step 4 has compared, step 5 doesn't compare again, with and without counting links."""
    monkeypatch.setattr(jj, "BLOCK", 7)
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    df = brute.documents(spark, _copies(rng, vocabulary, base, 60, 6))
    real, seen = jj.verified, []

    def spy(pairs, *rest):
        seen.append({tuple(r) for r in pairs.collect()})
        return real(pairs, *rest)

    monkeypatch.setattr(jj, "verified", spy)
    for links in (True, False):
        seen.clear()
        jj.jaccard_components(df, 3, 90, 100, count_links=links).collect()
        assert len(seen) == 2 and seen[0] and not seen[0] & seen[1]
