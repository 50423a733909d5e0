"""Toxicity by compression distance.

Two zstandard dictionaries are trained on short windows, one on toxic and one
on ordinary text, each put in front of a common background dictionary. A
window's distance is its compressed length with the ordinary dictionary less
that with the toxic one. A text's windows are counted by distance; the counts
become a score through log-likelihood ratios and a logistic calibration, both
learned from labelled texts that the dictionaries haven't seen.

Training refines the samples: dictionaries of one half of the labelled texts
pick, by distance, the windows of the other half that resemble its class, and
the words that carry that distance are kept where they recur.

The fit reads a bounded sample: at most ``rows`` labelled documents of a class
(those first in the order of a hash of the id) of at most ``ROW_BYTES`` bytes.
Scoring reads every text whole. NULL and empty texts have no windows and get
the score of no evidence. Without labels of both classes every score is 0.
Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import annotate
from tessera.llm.scan import LOWER, PLAIN, Texts, words_of

ROWS = {1: 1800, 0: 3600}
ROW_BYTES = 32 << 10
WINDOW_WORDS = 10
TRAIN_WORDS = 3
BACKGROUND_BYTES, FIRST_BYTES, NEXT_BYTES, LAST_BYTES = 16384, 16384, 4096, 1024
BACKGROUND_WINDOWS = 100_000
LEVEL = 12
FAR = 8  # distances are counted from -FAR to FAR
FIELDS = [T.StructField("score", T.DoubleType(), False), T.StructField("n_windows", T.LongType(), False)]


@dataclass
class Model:
    """The two dictionaries, the ratio per distance, and the calibration."""

    ordinary: bytes
    toxic: bytes
    ratio: np.ndarray
    rate: np.ndarray  # ordinary windows per distance
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False
    )


def _lengths(c: zstandard.ZstdCompressor, data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    parts = np.stack([start, size], 1).astype("<u8").tobytes()
    out = c.multi_compress_to_buffer(zstandard.BufferWithSegments(data, parts), threads=1)
    return np.fromiter((len(x) for x in out), np.int64, len(start))


def _sizes(c: zstandard.ZstdCompressor, windows: list[bytes]) -> np.ndarray:
    size = np.array([len(w) for w in windows], np.int64)
    if not len(size):
        return size
    return _lengths(c, b"".join(windows), np.cumsum(size) - size, size)


def _distance(ordinary, toxic, windows: list[bytes]) -> np.ndarray:
    return _sizes(ordinary, windows) - _sizes(toxic, windows)


def _windows(t: Texts, words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, size and text of every run of ``words`` words."""
    w = words_of(t, PLAIN)
    nth = np.arange(len(w.start)) - w.first[w.text]
    head = np.flatnonzero(nth % words == 0)
    last = np.minimum(head + words, w.first[w.text[head] + 1]) - 1
    return LOWER[t.data].tobytes(), w.start[head], w.end[last] - w.start[head], w.text[head]


def _train_windows(texts: list[str]) -> list[bytes]:
    raw = [x.encode() for x in texts]
    t = Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), None)
    data, start, size, _ = _windows(t, TRAIN_WORDS)
    return list(dict.fromkeys(data[a : a + n] for a, n in zip(start, size)))


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:].rjust(256)


def _carriers(ordinary, toxic, windows: list[bytes], least: int) -> list[bytes]:
    """Of every window at ``least`` or farther, the word whose loss shortens that most."""
    d = _distance(ordinary, toxic, windows)
    far = [(w, x) for w, x in zip(windows, d) if x >= least]
    parts = [w.split() for w, _ in far]
    without = [b" ".join(p[:j] + p[j + 1 :]) or b" " for p in parts for j in range(len(p))]
    rest, at, out = _distance(ordinary, toxic, without), 0, []
    for (_, x), p in zip(far, parts):
        drop = x - rest[at : at + len(p)]
        at += len(p)
        j = int(drop.argmax())
        if drop[j] >= least:
            out.append(p[j].strip(b".,;:!?"))
    return out


def _rates(texts: list[str]) -> Counter:
    """Share of the texts that hold a word."""
    seen = Counter(w for x in texts for w in {p.strip(b".,;:!?") for p in x.lower().encode().split()})
    return Counter({w: n / len(texts) for w, n in seen.items()})


def _phrases(words: list[bytes]) -> list[bytes]:
    """Samples of four words each, in a fixed random order."""
    order = np.random.default_rng(7).permutation(len(words))
    return [b" " + b" ".join(words[i] for i in order[a : a + 4]) + b" " for a in range(0, len(order), 4)]


def _pair(size: int, toxic: list[bytes], ordinary: list[bytes], back: bytes) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries of equal size on the common background."""
    return _dictionary(size, ordinary[: max(len(toxic), 300)]) + back, _dictionary(size, toxic) + back


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    halves = {
        1: [_train_windows(toxic[::2]), _train_windows(toxic[1::2])],
        0: [_train_windows(ordinary[::2]), _train_windows(ordinary[1::2])],
    }
    for a, b in halves.values():  # copies must not vouch for each other
        both = set(a) & set(b)
        a[:], b[:] = [w for w in a if w not in both], [w for w in b if w not in both]
    back = _dictionary(BACKGROUND_BYTES, (halves[0][0] + halves[0][1])[:BACKGROUND_WINDOWS])
    plain = _compressor(back)
    rare = {
        y: [[w for w, n in zip(h, _sizes(plain, h)) if n - 9 > 0.7 * len(w)] for h in halves[y]] for y in halves
    }
    pairs = [_pair(FIRST_BYTES, rare[1][h], rare[0][h], back) for h in (0, 1)]
    for _ in range(2):
        near = {1: [], 0: []}
        for h in (0, 1):
            o, t = (_compressor(x) for x in pairs[1 - h])
            near[1].append([w for w, x in zip(halves[1][h], _distance(o, t, halves[1][h])) if x >= 2])
            near[0].append([w for w, x in zip(halves[0][h], _distance(o, t, halves[0][h])) if x <= -2])
        pairs = [_pair(NEXT_BYTES, near[1][h], near[0][h], back) for h in (0, 1)]
    found = {1: [], 0: []}
    for h in (0, 1):
        o, t = (_compressor(x) for x in pairs[1 - h])
        found[1] += _carriers(o, t, halves[1][h], 1)
        found[0] += _carriers(t, o, halves[0][h], 1)
    count = {y: Counter(found[y]) for y in found}
    least = max(3, len(toxic) // 300)
    rate = {1: _rates(toxic), 0: _rates(ordinary)}
    keep = lambda y, w: count[y][w] >= least and rate[y][w] > 3 * rate[1 - y][w]
    bad, good = [w for w in found[1] if keep(1, w)], [w for w in found[0] if keep(0, w)]
    bad, good = bad or found[1], good or found[0]
    size = LAST_BYTES
    return _dictionary(size, _phrases(good)) + back, _dictionary(size, _phrases(bad)) + back


def _counts(t: Texts, ordinary, toxic) -> np.ndarray:
    """Windows of every text by distance [texts, 2 * FAR + 1]."""
    data, start, size, text = _windows(t, WINDOW_WORDS)
    bins = 2 * FAR + 1
    if not len(start):
        return np.zeros((len(t), bins), np.int64)
    d = _lengths(ordinary, data, start, size) - _lengths(toxic, data, start, size)
    d = np.clip(d, -FAR, FAR) + FAR
    return np.bincount(text * bins + d, minlength=len(t) * bins).reshape(len(t), bins)


def _features(m: Model, h: np.ndarray) -> np.ndarray:
    n = h.sum(1)
    columns = [np.ones(len(h)), h @ m.ratio]
    for far in (2, 3):
        above = m.rate[FAR + far :].sum() * n
        columns.append((h[:, FAR + far :].sum(1) - above) / np.sqrt(above + 0.5))
    columns.append(np.log1p(n))
    return np.stack(columns, 1)


def _scores(m: Model, h: np.ndarray) -> np.ndarray:
    z = ((_features(m, h) - m.mean) / m.scale) @ m.weight
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _texts(rows: list[str]) -> Texts:
    raw = [x.encode() for x in rows]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), None)


def fit_texts(texts: list[str], toxic: list[int]) -> Model | None:
    """Learn from labelled texts; two of three train dictionaries, the third calibrates."""
    y = np.array(toxic)
    if not len(y) or y.min() == y.max():
        return None
    nth = np.zeros(len(y), int)
    for label in (0, 1):
        nth[y == label] = np.arange((y == label).sum())
    own = nth % 3 == 2
    pick = lambda label: [x for x, a, o in zip(texts, y, own) if a == label and not o]
    ordinary, bad = _dictionaries(pick(1), pick(0))
    h = _counts(_texts([x for x, o in zip(texts, own) if o]), _compressor(ordinary), _compressor(bad))
    y = y[own]
    share = [h[y == label].sum(0) + 2.0 for label in (0, 1)]
    share = [s / s.sum() for s in share]
    m = Model(ordinary, bad, np.log(share[1] / share[0]), share[0], np.zeros(5), np.ones(5), np.zeros(5))
    x = _features(m, h)
    m.mean, m.scale = x.mean(0), x.std(0) + 1e-9
    m.mean[0], m.scale[0] = 0, 1
    x = (x - m.mean) / m.scale
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ m.weight, -30, 30)))
        g = x.T @ (y - p) - 0.5 * m.weight
        m.weight += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(5), g)
    return m


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Learn from a bounded sample of the labelled documents.

    The chosen ids are at most ``sum(ROWS.values())``, so they are broadcast.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    known = known.groupBy("k").agg(F.max("y").alias("y"))
    # A threshold on the hash lets about twice the wanted rows through, however many there are.
    below = F.lit(0)
    for r in known.groupBy("y").agg(F.count("*").alias("n")).collect():  # two rows
        below = F.when(F.col("y") == r["y"], -(-(2 * ROWS[r["y"]] << 20) // r["n"])).otherwise(below)
    near = known.withColumn("h", F.xxhash64("k")).where(F.pmod("h", F.lit(1 << 20)) < below)
    nth = F.row_number().over(Window.partitionBy("y").orderBy("h", "k"))
    most = F.when(F.col("y") == 1, ROWS[1]).otherwise(ROWS[0])
    known = near.withColumn("n", nth).where(F.col("n") <= most).select("k", "y")
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    rows = rows.where(F.octet_length("t").between(1, ROW_BYTES)).join(F.broadcast(known), "k")
    got = sorted(rows.dropDuplicates(["k"]).select("k", "y", "t").collect(), key=lambda r: (str(r["k"]), r["t"]))
    return fit_texts([r["t"] for r in got], [r["y"] for r in got])


def score(docs: DataFrame, model: Model | None, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``_row`` (struct of ``carry``), ``score`` and ``n_windows`` per row; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(t: Texts) -> dict:
        m = sent.value
        if m is None:
            return {"score": np.zeros(len(t)), "n_windows": np.zeros(len(t), np.int64)}
        h = _counts(t, _compressor(m.ordinary), _compressor(m.toxic))
        return {"score": _scores(m, h), "n_windows": h.sum(1)}

    return annotate(docs, text, FIELDS, scan, carry)
