import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import bestfit_packing as bp
from tessera.llm.rowwise import unpacked
from tessera.llm.session import tokenizer_path
from tests.llm import brute


def _held(patterns):
    out = Counter()
    for filling, times in patterns:
        for length, n in filling:
            out[length] += n * times
    return out


def _fewest(items, capacity):
    """Fewest sequences, by trying everything."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best[0]


def test_search_finds_the_fewest_sequences():
    rng = random.Random(2)
    for _ in range(60):
        items = [rng.randrange(1, 31) for _ in range(rng.randrange(1, 10))]
        patterns = bp.pack_histogram(Counter(items), 30)
        assert _held(patterns) == Counter(items)
        assert all(sum(k * n for k, n in f) <= 30 for f, _ in patterns)
        assert sum(n for _, n in patterns) == _fewest(items, 30)
    assert bp.pack_histogram({}) == []


def test_search_is_near_the_bound_on_many():
    rng = np.random.default_rng(4)
    items = np.minimum(4096, rng.lognormal(6.5, 1, 20000).astype(int) + 1)
    counts = Counter(items.tolist())
    patterns = bp.pack_histogram(counts)
    assert _held(patterns) == counts
    assert sum(n for _, n in patterns) <= bp.lower_bound(counts, 4096) * 1.001 + 1


@pytest.fixture
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_pieces_and_places(spark, tokenizer):
    rng = random.Random(3)
    texts = brute.ODD_TEXTS + [" ".join(rng.choice(["Don't", "été", "thing,", "x1y", "漢字", "é"]) for _ in range(rng.randrange(400))) for _ in range(50)]
    texts += ["word " * 9000, "Σίσυφος İx y <|endoftext|> ﬁn"]
    df = brute.documents(spark, texts, extra=True)
    rows = unpacked(bp.best_fit_pack(df, tokenizer_path(), with_ids=True), *"piece start length ids_crc32 ids sequence_id offset".split()).collect()
    whole, places = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: r["piece"]):
        assert r["start"] == len(whole[r["doc_id"]]) and r["length"] == len(r["ids"]) <= bp.CAPACITY
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4"))
        whole[r["doc_id"]] += r["ids"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        assert whole[i] == tokenizer.encode(t or "", add_special_tokens=False).ids + [bp.END_ID]
    for held in places.values():
        held.sort()
        assert [a for a, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= bp.CAPACITY
    assert len(places) <= bp.lower_bound(Counter(r["length"] for r in rows), bp.CAPACITY) + 1


def test_repeats_nulls_and_nothing(spark):
    rows = [(1, "same"), (1, "same"), (None, "same"), (None, None)]
    got = unpacked(bp.best_fit_pack(brute.documents(spark, rows), tokenizer_path()), "length", "sequence_id", "offset").collect()
    assert len(got) == 4 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4
    assert bp.best_fit_pack(brute.documents(spark, []), tokenizer_path()).count() == 0


def test_search_resolves_wasteful_sequences():
    for seed, capacity in ((9, 100), (14, 60), (20, 1000), (37, 1000)):
        rng = random.Random(seed)
        assert rng.choice([60, 100, 1000]) == capacity
        items = [rng.randrange(capacity // 7, capacity * 2 // 3) for _ in range(rng.choice([20, 60, 300]))]
        patterns = bp.pack_histogram(Counter(items), capacity)
        assert _held(patterns) == Counter(items)
        assert sum(n for _, n in patterns) == bp.lower_bound(Counter(items), capacity)


def test_a_spent_budget_is_told(caplog):
    rng = random.Random(20)
    rng.choice([60, 100, 1000])
    items = Counter(rng.randrange(142, 666) for _ in range(rng.choice([20, 60, 300])))
    bp.pack_histogram(items, 1000, nodes=1)
    assert "search budget spent" in caplog.text
