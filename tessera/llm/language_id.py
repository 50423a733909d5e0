"""Language spans: script ranges, per-word scores, Viterbi with a switching cost.

A word's script (from fixed code point ranges) narrows the languages that can
claim it. The remaining ones get the log-likelihood of the word's byte trigrams
under each language, learned from labelled texts. Viterbi over the words of a
whole text, with a fixed cost for switching language, labels spans of mixed
texts; a text's language is the one that holds most letters.

NULL texts, empty texts and texts without a letter are ``und`` with score 0 and
no spans. With no labelled rows at all every text is ``und``. Of more than
``MOST_LANGS`` languages those with most labelled rows are learned (of equal counts
the first in name order), with a warning; texts in the others get the nearest
learned one. Words without a
letter follow their neighbours. Ties go to the language first in name order.
Repeated rows are labelled one by one; texts are read whole.

The model is fitted on a bounded sample: the ``rows_per_lang`` labelled rows of
each language that come first in the order of a hash of the row's id. A first
count sets a threshold on that hash, so that about twice as many rows leave the
scan, however many there are.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import annotate
from tessera.llm.scan import LOWER, PLAIN, Texts, Words, mix, slices, words_of
from tessera.llm.viterbi import decode, decode_switching

ROWS_PER_LANG = 400
MOST_LANGS = 256
BUCKETS = 1 << 16
SWITCH_COST = 12.0
#: up to so many languages are decoded in segments, more step by step (the same paths)
FEW_LANGS = 8
#: scores (words by languages) held at a time; a longer text is held whole
CELLS = 1 << 22
UNKNOWN = "und"
# Code point ranges of letters by script.
RANGES = {
    "latin": "0041-005A 0061-007A 00AA-00AA 00BA-00BA 00C0-00D6 00D8-00F6 00F8-02AF 1D00-1D7F 1E00-1EFF 2C60-2C7F A720-A7FF "
    "AB30-AB6F FB00-FB06 FF21-FF3A FF41-FF5A",
    "greek": "0370-03FF 1F00-1FFF",
    "cyrillic": "0400-052F 1C80-1C8F 2DE0-2DFF A640-A69F",
    "armenian": "0531-058F FB13-FB17",
    "hebrew": "0591-05F4 FB1D-FB4F",
    "arabic": "0600-06FF 0750-077F 0870-08FF FB50-FDFF FE70-FEFC",
    "syriac_thaana": "0700-074F 0780-086F",
    "indic": "0900-0DFF A8E0-A8FF",
    "thai_lao": "0E00-0EFF",
    "tibetan": "0F00-0FFF",
    "burmese_khmer": "1000-109F 1780-17FF 19E0-19FF A9E0-A9FF AA60-AA7F",
    "georgian": "10A0-10FF 1C90-1CBF 2D00-2D2F",
    "ethiopic": "1200-139F 2D80-2DDF AB00-AB2F",
    "hangul": "1100-11FF 3130-318F A960-A97F AC00-D7FF",
    "kana": "3040-30FF 31F0-31FF FF66-FF9D",
    "han": "3005-3007 3100-312F 31A0-31BF 3400-4DBF 4E00-9FFF F900-FAFF 20000-323AF",
}
SCRIPTS = (*RANGES, "other")
_table = sorted((*(int(x, 16) for x in r.split("-")), k) for k, name in enumerate(RANGES) for r in RANGES[name].split())
_starts, _ends, _scripts = (np.array(c) for c in zip(*_table))
#: letters of no listed range: from here on
FIRST_OTHER = 0x0530


def scripts_of(data: np.ndarray) -> np.ndarray:
    """Script of the letter that starts at each byte of a UTF-8 array; -1 elsewhere."""
    out = np.full(len(data), -1, np.int8)
    out[(data | 0x20 >= 0x61) & (data | 0x20 <= 0x7A) & (data < 0x80)] = 0  # latin is the first
    lead = np.flatnonzero(data >= 0xC2)
    if not len(lead):
        return out
    first, last = data[lead].astype(np.int64), len(data) - 1
    tail = [data[np.minimum(lead + k, last)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
    two = (first & 0x1F) << 6 | tail[0]
    three = (first & 0x0F) << 12 | tail[0] << 6 | tail[1]
    four = (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
    point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    at = np.searchsorted(_starts, point, "right") - 1
    inside = (at >= 0) & (point <= _ends[at])
    # Punctuation, symbols, private and surrogate blocks hold no letters.
    letter = (point >= FIRST_OTHER) & ~((point >= 0x2000) & (point <= 0x2BFF)) & ~((point >= 0x3000) & (point <= 0x303F))
    letter &= ~((point >= 0xD800) & (point <= 0xF8FF)) & ~((point >= 0xFE00) & (point <= 0xFFFF)) & (point < 0x1F000)
    out[lead] = np.where(inside, _scripts[at], np.where(letter, len(SCRIPTS) - 1, -1))
    return out


SPAN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]
)
FIELDS = [
    T.StructField("lang_pred", T.StringType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("spans", T.ArrayType(SPAN, False), False),
]


@dataclass
class Model:
    """Languages, log-probabilities per trigram bucket, and allowed scripts."""

    langs: list[str]
    grams: np.ndarray  # [BUCKETS, languages]
    scripts: np.ndarray  # [scripts, languages] bool


def _grams(data: np.ndarray) -> np.ndarray:
    """Bucket of the byte trigram around every byte; separators count as one space."""
    c = np.where(PLAIN[data], LOWER[data], 0x20).astype(np.uint64)
    p = np.concatenate([[np.uint64(0x20)], c, [np.uint64(0x20)]])
    return (mix(p[:-2] << np.uint64(16) | p[1:-1] << np.uint64(8) | p[2:]) >> np.uint64(48)).astype(np.int64)


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows_per_lang: int = ROWS_PER_LANG,
) -> Model:
    """Learn from a bounded sample of rows with a language and a text."""
    rows = labelled.select(
        F.col(f"`{text}`").cast("string").alias("t"),
        F.col(f"`{lang}`").cast("string").alias("l"),
        F.xxhash64(F.col(f"`{key}`")).alias("h"),
    ).where("t is not null and l is not null")
    counts = rows.groupBy("l").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "l").limit(MOST_LANGS + 1).collect()
    if len(counts) > MOST_LANGS:
        warnings.warn(f"only the {MOST_LANGS} languages with most labelled rows are learned", stacklevel=2)
        counts = counts[:MOST_LANGS]
    below = F.lit(0)
    for r in counts:
        below = F.when(F.col("l") == r["l"], -(-(2 * rows_per_lang << 20) // r["n"])).otherwise(below)
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) < below)
    nth = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    sample = sample.withColumn("_n", nth).where(F.col("_n") <= rows_per_lang).select("l", "t")
    schema = "l string, grams binary, scripts binary"

    def count(batches):
        for part in slices(batches, "t"):
            names = np.array(part.rows.column("l").to_pylist(), object)
            at = np.repeat(np.arange(len(part)), np.diff(part.offsets))
            inside, gram, script = PLAIN[part.data], _grams(part.data), scripts_of(part.data)
            for name in sorted(set(names)):
                own = (names == name)[at]
                g = np.bincount(gram[own & inside], minlength=BUCKETS).astype("<i8")
                s = np.bincount(script[own & (script >= 0)], minlength=len(SCRIPTS)).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([g.tobytes()], pa.binary()), pa.array([s.tobytes()], pa.binary())],
                    ["l", "grams", "scripts"],
                )

    def add(parts):
        grams = sum(np.frombuffer(x, "<i8") for x in parts["grams"])
        scripts = sum(np.frombuffer(x, "<i8") for x in parts["scripts"])
        parts = parts.iloc[:1].copy()
        parts["grams"], parts["scripts"] = [grams.tobytes()], [scripts.tobytes()]
        return parts

    found = sample.mapInArrow(count, schema).groupBy("l").applyInPandas(add, schema).collect()
    found.sort(key=lambda r: r["l"])
    grams = np.array([np.frombuffer(r["grams"], "<i8") for r in found], float).reshape(len(found), BUCKETS).T
    scripts = np.array([np.frombuffer(r["scripts"], "<i8") for r in found], float).reshape(len(found), len(SCRIPTS)).T
    prob = np.log((grams + 0.2) / (grams.sum(0) + 0.2 * BUCKETS)) if len(found) else grams
    return Model([r["l"] for r in found], prob.astype(np.float32), scripts > 0.001 * scripts.sum(0))


def _has_letter(raw: np.ndarray) -> bool:
    folded = raw | 0x20
    if ((folded >= 0x61) & (folded <= 0x7A)).any():
        return True
    return bool((raw >= 0x80).any()) and any(ch.isalpha() for ch in raw.tobytes().decode())


def _tags(t: Texts, w: Words, m: Model, script: np.ndarray, weight: np.ndarray, switch: float) -> np.ndarray:
    """Language number of every word; runs of whole texts of about ``CELLS`` scores are worked on at a time."""
    k, gram = len(m.langs), _grams(t.data)
    out, lo = np.empty(len(w.start), np.int64), 0
    while lo < len(t):
        hi = max(lo + 1, int(np.searchsorted(w.first, w.first[lo] + CELLS // k, "right")) - 1)
        a, b = int(w.first[lo]), int(w.first[hi])
        begin, end = int(t.offsets[lo]), int(t.offsets[hi])
        first, lo = w.first[lo : hi + 1] - a, hi
        if a == b:
            continue
        start, stop = w.start[a:b] - begin, w.end[a:b] - begin
        emit = np.empty((b - a, k), np.float32)
        total = np.zeros(end - begin + 1)
        for j in range(k):
            np.cumsum(m.grams[gram[begin:end], j], out=total[1:])
            emit[:, j] = total[stop] - total[start]
        top = np.maximum.reduceat(script[begin:end], start)  # ranges after a word hold no letters
        allowed = m.scripts[np.maximum(top, 0)]
        allowed[~allowed.any(1)] = True
        emit[~allowed] = -1e6
        emit -= emit.max(1, keepdims=True)
        np.maximum(emit, -40.0, out=emit)
        emit[weight[a:b] == 0] = 0
        if k > FEW_LANGS:
            out[a:b] = decode_switching(emit, switch, first)
        else:
            change = np.full((k, k), -switch)
            np.fill_diagonal(change, 0)
            out[a:b] = decode(emit, change, first)
    return out


def label(t: Texts, m: Model, switch: float = SWITCH_COST) -> dict[str, list]:
    """Language, score and spans of every text of a slice."""
    n, k = len(t), len(m.langs)
    out = {"lang_pred": [UNKNOWN] * n, "score": [0.0] * n, "spans": [[] for _ in range(n)]}
    w = words_of(t, PLAIN)
    if not len(w.start) or not k:
        return out
    script = scripts_of(t.data)
    letters = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(script >= 0, out=letters[1:])
    weight = letters[w.end] - letters[w.start]
    tag = _tags(t, w, m, script, weight, switch)
    held = np.bincount(w.text * k + tag, weights=weight, minlength=n * k).reshape(n, k)
    best, of_all = held.argmax(1), held.sum(1)
    points = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum((t.data & 0xC0) != 0x80, out=points[1:])
    turn = np.ones(len(tag) + 1, bool)
    turn[1:-1] = (tag[1:] != tag[:-1]) | (w.text[1:] != w.text[:-1])
    turn = np.flatnonzero(turn)
    for a, b in zip(turn[:-1], turn[1:]):
        i = w.text[a]
        base = points[t.offsets[i]]
        span = {"start": int(points[w.start[a]] - base), "end": int(points[w.end[b - 1]] - base), "lang": m.langs[tag[a]]}
        out["spans"][i].append(span)
    for i in range(n):
        raw = t.data[t.offsets[i] : t.offsets[i + 1]]
        if not len(raw) or not _has_letter(raw):
            out["spans"][i] = []
            continue
        out["lang_pred"][i] = m.langs[best[i]]
        out["score"][i] = float(held[i, best[i]] / of_all[i]) if of_all[i] else 0.0
    return out


def identify(
    docs: DataFrame, model: Model, text: str = "text", carry: Sequence[str] = ("doc_id",), switch: float = SWITCH_COST
) -> DataFrame:
    """``_row`` (struct of ``carry``), ``lang_pred``, ``score`` and ``spans`` per row.

    The broadcast model has a fixed size: ``BUCKETS`` by at most ``MOST_LANGS``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text, FIELDS, lambda t: label(t, sent.value, switch), carry)
