import hashlib
import random

import numpy as np

from tessera.llm import suffix_dedup as sd
from tessera.llm.rowwise import unpacked
from tests.llm import brute


def _check(spark, rows, extra=False):
    got = unpacked(sd.dedup(brute.documents(spark, rows, extra)), "n_bytes", "n_removed", "spans", "kept_sha256")
    got = {r["doc_id"]: r for r in got.collect()}
    for i, (raw, cover) in brute.removed(rows).items():
        r = got[i]
        kept = bytes(b for k, b in enumerate(raw) if k not in cover)
        runs = sum(k - 1 not in cover for k in cover)
        assert (r["n_bytes"], r["n_removed"], len(r["spans"])) == (len(raw), len(cover), runs), i
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_matches_all_strings(spark):
    rng = random.Random(9)
    line = lambda n, a="abé ": "".join(rng.choice(a) for _ in range(n))
    passage, tail = line(70), line(49)
    texts = list(brute.ODD_TEXTS)
    texts += [line(rng.randrange(30)) + passage + line(rng.randrange(30)) for _ in range(6)]
    texts += [line(40) + passage[:60] + line(9) + passage[5:], tail + line(20), line(20) + tail, passage[:40], passage]
    texts += [line(200, "ab") for _ in range(5)] + ["ab" * 90, "ba" * 60, passage * 3]
    copies = [texts[12], texts[12], texts[13][:-1] + "z"]
    rows = list(enumerate(texts + copies))
    rng.shuffle(rows)
    _check(spark, rows, extra=True)


def test_boundary_lengths(spark):
    base = "".join(chr(97 + i * 7 % 26) for i in range(120))
    rows = [(0, base), (1, base[10:59]), (2, base[10:60]), (3, "x" + base[20:71] + "y"), (4, base + base)]
    _check(spark, rows)


def test_null_ids_and_nothing(spark):
    text = "q" * 30 + "some passage that is long enough to be removed from one of them"
    got = unpacked(sd.dedup(brute.documents(spark, [(None, text), (3, text), (3, text)])), "n_removed").collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("3", 0), ("3", 0), ("None", len(text))]
    assert sd.dedup(brute.documents(spark, [])).count() == 0


def test_texts_that_share_an_id_or_have_none(spark):
    """Repeats are told by text: a second text of an id, or a second one without an id, keeps its own bytes."""
    rng = random.Random(4)
    line = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = line(80)
    texts = [(1, line(60) + passage), (5, line(20) + passage + line(9)), (5, line(150)), (None, line(33) + passage), (None, line(140))]
    texts += [(None, texts[4][1][:70] + line(40)), (5, texts[2][1][:90] + line(10))]
    got = sd.dedup(brute.documents(spark, texts), carry=("doc_id", "text")).collect()
    big = 1 << 62
    for r in got:
        own = big if r["_row"]["doc_id"] is None else r["_row"]["doc_id"]
        others = [(i if i is not None else big, t) for i, t in texts if (i if i is not None else big) < own]
        raw, cover = brute.removed([(own, r["_row"]["text"]), *others])[own]
        assert r["n_removed"] == len(cover) and r["n_bytes"] == len(raw)
    assert sorted(r["n_removed"] for r in got) == [0, 0, 0, 0, 0, 80, 80]


def test_runs_merge_where_they_touch():
    assert sd.removed_spans(np.array([5, 6, 55, 200]), 50).tolist() == [[5, 105], [200, 250]]
    assert sd.removed_spans(np.array([0, 51]), 50).tolist() == [[0, 50], [51, 101]]


def test_sampled_places_in_slices():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 2000).astype(np.uint8)
    for at in ([0], [1980], [40, 55, 300, 1980], sorted(rng.choice(1980, 25, replace=False).tolist())):
        inside = {p for x in at for p in range(max(x - 30, 0), min(x + 50, len(data)))}
        expected = {}
        for p in inside:
            lo, hi = p, p
            while lo - 1 in inside:
                lo -= 1
            while hi in inside:
                hi += 1
            if p % 3 and p + 24 <= hi:
                expected[p] = (lo, hi)
        for size in (7, 100, 1 << 17):
            got = [x for part in sd.sampled_places(data, np.array(at), 50, size) for x in zip(*(c.tolist() for c in part))]
            assert {j: (lo, hi) for j, lo, hi in got} == expected and len(got) == len(expected)


def test_long_text_is_one_across_its_pieces(spark):
    rng = np.random.default_rng(8)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    long = letters(sd.PIECE + 4000)
    near = long[sd.PIECE - 300 : sd.PIECE + 300]
    got = sd.dedup(brute.documents(spark, [(1, long), (2, "ü" + near + letters(90)), (3, letters(40) + long[:-1] + "-")]))
    spans = {r["_row"]["doc_id"]: [tuple(x) for x in r["spans"]] for r in got.collect()}
    assert spans == {1: [], 2: [(2, 602)], 3: [(40, 40 + len(long) - 1)]}


def test_distinct_keys_come_back_from_their_blobs(monkeypatch):
    rng = np.random.default_rng(5)
    columns = [rng.integers(0, 4, 500).astype(np.uint64) << np.uint64(62), *rng.integers(0, 3, (2, 500)).astype(np.uint64)]
    for mix in (sd.mix, lambda x: x & np.uint64(1)):  # the second: many keys with one hash
        monkeypatch.setattr(sd, "mix", mix)
        first, place = sd.distinct(columns)
        keys = [x[first] for x in columns]
        assert all((x[place] == y).all() for x, y in zip(keys, columns))
        assert len(set(zip(*(x.tolist() for x in keys)))) == len(first) and (np.diff(keys[0].astype(object)) >= 0).all()
        assert (sd.unpack(sd.pack(keys), len(first), 3) == np.stack(keys)).all()
    many = sd.named(np.stack([*columns, np.zeros(500, np.uint64)])).tolist()
    rows = list(zip(*(x.tolist() for x in columns)))
    assert many == [2 * sorted(set(rows)).index(r) + (rows.count(r) > 1) for r in rows]


def test_chunks_of_a_group_send_a_bucket_one_blob(spark, monkeypatch):
    """With a blob a chunk and bucket there would be chunks times buckets of them."""
    rng = random.Random(12)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [line(rng.randrange(50, 90)) for _ in range(30)]
    rows = [(i, "".join(line(rng.randrange(60)) + rng.choice(passages) for _ in range(5))) for i in range(160)]
    counts, add = {}, sd.Tables.add

    def counted(self, df, name):
        out = add(self, df, name)
        counts.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(sd.Tables, "add", counted)
    monkeypatch.setattr(sd, "CHUNK", 1 << 11)
    monkeypatch.setattr(sd, "group_bits", lambda chunks: 3 if chunks > 20 else 0)
    _check(spark, rows)
    buckets = sum(len(t.encode()) for _, t in rows) // sd.CHUNK
    most = counts["chunks"][0] * buckets / 3
    assert counts["chunks"][0] > 30 and buckets > 10
    assert 0 < counts["flags"][0] < most and 0 < sum(counts["names"]) < most
    assert len(counts["names"]) == 2 and all(counts["names"])  # in turn, so that half of the triples are on disk at once


def test_answers_of_a_group_reach_their_chunks(monkeypatch):
    rng = np.random.default_rng(6)
    keys = {c: np.sort(rng.integers(0, 1 << 62, int(rng.integers(0, 400))).astype(np.uint64)) for c in [*range(3, 19), 1 << 32]}
    chunks = [sd.pa.table({"c": [c]}) for c in keys]

    def ask(rows):
        k = keys[rows.column("c")[0].as_py()]
        return (k >> np.uint64(57)).astype(np.int64), [k, k & np.uint64(1)]

    for held, most in ((1 << 26, 4 * 32), (1, 17 * 32)):  # four groups; a chunk at a time
        monkeypatch.setattr(sd, "HELD", held)
        tables = list(sd.asked(chunks, 3, ask))
        assert sum(t.num_rows for t in tables) <= most
        got = {}
        for t in tables:
            for row in t.to_pylist():
                m = sd.unpack(row["blob"], sum(row["n"]), 2)
                assert (m[0] >> np.uint64(57) == row["bucket"]).all() and (m[1] == m[0] & np.uint64(1)).all()
                got.setdefault(row["g"], []).append(row | {"blob": sd.pack([m[0] * np.uint64(3)])})
        for g, rows in got.items():
            rng.shuffle(rows)
            replies = sd.Replies(sd.pa.Table.from_pylist(rows, schema=sd._BLOBS))
            for c in (c for c in keys if c >> 3 == g):
                answers, bucket = replies.take(c)
                assert (answers == keys[c] * np.uint64(3)).all() and (bucket == keys[c] >> np.uint64(57)).all()
    assert [sd.group_bits(n) for n in (0, 255, 256, 512, 1024, 1 << 20)] == [0, 0, 1, 2, 3, 3]


def test_rows_in_the_order_of_their_columns():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 500):
        for wide in (1, 2, 9, 1 << 40):
            columns = rng.integers(0, wide, (3, n)).astype(np.uint64) << np.uint64(23)
            order, new = sd.in_order(columns)
            plain = np.lexsort(columns[::-1])
            assert sorted(order.tolist()) == list(range(n)) and (columns[:, order] == columns[:, plain]).all()
            assert (new == sd._changes(columns, plain)).all()


def test_regions_end_with_their_piece():
    data = np.full(300, 97, np.uint8)
    at, start, end = np.array([3, 90, 95, 101, 260]), np.array([0, 0, 0, 101, 101]), np.array([100, 100, 100, 299, 299])
    lo, hi = sd.regions_of(at, 50, start, end)
    assert (lo.tolist(), hi.tolist()) == ([0, 60, 101, 230], [53, 100, 151, 299])
    inside = np.flatnonzero(sd.covered(data, at, 50, start, end))
    assert inside.tolist() == [*range(53), *range(60, 100), *range(101, 151), *range(230, 299)]
