"""Scanning, Viterbi and connected components against plain versions."""

import random

import numpy as np
import pyarrow as pa

from tessera.llm import scan
from tessera.llm.components import connected_components
from tessera.llm.viterbi import decode, decode_switching
from tests.llm import brute


def _texts(rows):
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["t"])


def test_words_and_shingles_are_those_of_the_patterns():
    rng = random.Random(3)
    rows = ["".join(rng.choice("aB1 \n\té#\x0b€z") for _ in range(rng.randrange(40))) for _ in range(300)] + [None, ""]
    for table, pattern in ((scan.PLAIN, brute.PLAIN), (scan.ALNUM, brute.ALNUM)):
        seen = {}
        for t in scan.slices(iter([_texts(rows)]), "t", most=200):
            w = scan.words_of(t, table)
            own = scan.word_hashes(t, w, True)
            at, h = scan.shingle_hashes(own, w, 3)
            for k, text in enumerate(t.rows.column("t").to_pylist()):
                got = [t.data[a:b].tobytes().decode().translate(brute.LOWER) for a, b in zip(w.start, w.end) if t.offsets[k] <= a < t.offsets[k + 1]]
                want = brute.words(text, pattern, lower=True)
                assert got == want and w.first[k + 1] - w.first[k] == len(want)
                mine = [int(x) for a, x in zip(at, h) if w.text[a] == k]
                for g, x in zip(zip(want, want[1:], want[2:]), mine, strict=True):
                    assert seen.setdefault(g, x) == x
        assert len(set(seen.values())) == len(seen)


def test_range_hash_depends_on_content_only():
    data = np.frombuffer(b"abcXabcYabcd", np.uint8)
    p = scan.prefix_hash(data)
    h = scan.range_hash(p, np.array([0, 4, 8, 8]), np.array([3, 7, 11, 12]))
    assert h[0] == h[1] == h[2] != h[3]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(20):
        k = int(rng.integers(1, 6))
        first = np.concatenate([[0], np.cumsum(rng.integers(0, 150, 8))])
        e, c = rng.normal(0, 9, (first[-1], k)), rng.normal(0, 4, (k, k))
        got = decode(e, c, first)
        for a, b in zip(first, first[1:]):
            if a == b:
                continue
            best = e[a]
            for t in range(a + 1, b):
                best = (best[:, None] + c).max(0) + e[t]
            path = got[a:b]
            assert abs(e[a:b][range(b - a), path].sum() + c[path[:-1], path[1:]].sum() - best.max()) < 0.05
    assert len(decode(np.zeros((0, 3)), np.zeros((3, 3)), np.array([0, 0]))) == 0


def test_one_switching_cost_gives_the_same_paths():
    rng = np.random.default_rng(2)
    for k in (1, 2, 5, 9, 17, 130, 300):
        first = np.concatenate([[0], np.cumsum(rng.integers(0, 90 if k < 20 else 9, 8))])
        e = rng.integers(-9, 9, (first[-1], k)).astype(float)  # with ties
        for cost in (0.0, 4.0):
            c = np.full((k, k), -cost)
            np.fill_diagonal(c, 0)
            got = decode_switching(e, cost, first)
            for a, b in zip(first, first[1:]):
                if a == b:
                    continue
                best, came = e[a], []
                for t in range(a + 1, b):
                    every = best[:, None] + c
                    came.append(every.argmax(0))
                    best = every.max(0) + e[t]
                path = [int(best.argmax())]
                for step in reversed(came):
                    path.append(int(step[path[-1]]))
                assert got[a:b].tolist() == path[::-1]
    many = rng.normal(0, 9, (4, 130))
    same = np.where(np.eye(130, dtype=bool), 0.0, -4.0)
    assert (decode(many, same, np.array([0, 4])) == decode_switching(many, 4.0, np.array([0, 4]))).all()
    assert len(decode_switching(np.zeros((0, 3)), 1.0, np.array([0, 0]))) == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(40)] + [(1, 1)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = brute.components({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in want.items() if n in got}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
