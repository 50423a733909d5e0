"""Benchmark decontamination with one Aho-Corasick automaton.

The windows (``window`` consecutive words) of all benchmark texts, normalised
to lower-case words with single spaces, form one automaton. A document is
normalised the same way and scanned once; the words of a match are mapped back
to their byte offsets in the original text.

A benchmark text with fewer words than a window is one window; one without
words (or NULL) has none. An item without an id hits like others but is not listed.
NULL and empty documents have no words and no hits.
Equal windows of several items report all of them. Repeated document rows are
scanned one by one. An empty benchmark hits nothing.

The benchmark is a stated query set of at most ``MOST_BYTES`` of text; a larger one
is refused before anything is read. It is read in blocks of at most ``BLOCK_BYTES``,
each block broadcast as one automaton's input, and the documents pass the blocks
one after the other in the same narrow stage. A worker keeps the automata of the
running call only.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import annotate, annotate_whole, whole_rows
from tessera.llm.scan import ALNUM, LOWER, Texts, words_of

WINDOW = 10
BLOCK_BYTES = 16 << 20
MOST_BYTES = 64 << 20
#: one byte each: letters lower-cased, separators turned into spaces
NORMAL = np.where(ALNUM, LOWER, 0x20).astype(np.uint8)
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FIELDS = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
    T.StructField("spans", T.ArrayType(SPAN, False), False),
]
_automata: dict[str, object] = {}


def benchmark_blocks(benchmark: DataFrame, item: str, text: str) -> list[list[tuple[str, str]]]:
    """The items as lists of (id, text), each list at most ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t"))
    items = items.where("t is not null")
    size = items.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    if size > MOST_BYTES:
        raise ValueError(f"the benchmark has {size} bytes of text; at most {MOST_BYTES} are compared at once")
    n = max(1, -(-2 * size // BLOCK_BYTES)) if size > BLOCK_BYTES else 1
    blocks = []
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else items
        blocks.append([(r["i"], r["t"]) for r in part.distinct().collect()])
    return [b for b in blocks if b]


def _automaton(key: str, items: list[tuple[str, str]], window: int):
    """The block's automaton; built once per Python worker."""
    if key not in _automata:
        import ahocorasick

        found = defaultdict(set)
        for name, text in items:
            words = NORMAL[np.frombuffer(text.encode(), np.uint8)].tobytes().split()
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                found[b" " + b" ".join(words[i : i + size]) + b" "].add(name)
        a = ahocorasick.Automaton()
        for p, names in found.items():
            a.add_word(p.decode("latin-1"), (p.count(b" ") - 1, tuple(n for n in names if n is not None)))
        if found:
            a.make_automaton()
        _automata[key] = a if found else None
    return _automata[key]


def _scan_text(data: bytes, automata: list) -> tuple[int, np.ndarray, set]:
    """(words, marks of hit words, items) of one normalised text."""
    words = data.split()
    hit, items = np.zeros(len(words) + 1, np.int64), set()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    spaces = None
    for a in automata:
        for end, (size, names) in a.iter(line) if words else ():
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            last = int(np.searchsorted(spaces, end))
            hit[last - size] += 1
            hit[last] -= 1
            items.update(names)
    return len(words), np.cumsum(hit[:-1]) > 0, items


def _code_points(t: Texts, k: int, hit: np.ndarray) -> list[dict]:
    """The hit words of text k as maximal spans in code points of the original."""
    raw = t.data[t.offsets[k] : t.offsets[k + 1]]
    w = words_of(Texts(raw, np.array([0, len(raw)]), None), ALNUM)
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=at[1:])
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    return [{"start": int(at[w.start[a]]), "end": int(at[w.end[b]])} for a, b in zip(first, last)]


def _scanner(benchmark: DataFrame, item: str, item_text: str, window: int) -> Callable[[Texts], dict]:
    sc = benchmark.sparkSession.sparkContext
    blocks = [
        (f"{uuid.uuid4().hex}", sc.broadcast(b)) for b in benchmark_blocks(benchmark, item, item_text)
    ]

    def scan(t: Texts) -> dict:
        for old in _automata.keys() - {key for key, _ in blocks}:
            del _automata[old]
        automata = [a for a in (_automaton(key, b.value, window) for key, b in blocks) if a is not None]
        plain = NORMAL[t.data].tobytes()
        n_words, n_hit, items, spans = [], [], [], []
        for k in range(len(t)):
            n, hit, names = _scan_text(plain[t.offsets[k] : t.offsets[k + 1]], automata)
            n_words.append(n)
            n_hit.append(int(hit.sum()))
            items.append(sorted(names))
            spans.append(_code_points(t, k, hit) if hit.any() else [])
        return {"n_words": n_words, "n_hit": n_hit, "items": items, "spans": spans}

    return scan


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``_row`` (struct of ``carry``), ``n_words``, ``n_hit``, ``items`` and ``spans``.

    ``items`` are the ids (as strings, sorted, distinct) of items with an
    occurring window; ``spans`` the maximal runs of hit words as code points of
    the original text, end exclusive.
    """
    return annotate(docs, text, FIELDS, _scanner(benchmark, item, item_text, window), carry)


def clean_rows(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The rows of ``docs``, all their columns, without a benchmark window."""
    got = annotate_whole(docs, text, FIELDS, _scanner(benchmark, item, item_text, window))
    return whole_rows(got.where("n_hit = 0"), docs.columns, text)
