"""Byte-level scanning of text columns in Arrow batches.

The operators of this subpackage read whole texts inside Spark tasks. These
helpers view a slice of an Arrow string column as one UTF-8 byte array and
find words, hash them and count per document with numpy, without creating a
Python string per word. All separators are ASCII bytes, so byte-wise scanning
of UTF-8 gives the same words as code-point scanning. A NULL text is an empty
text.

Memory per task: a slice holds about ``SLICE_BYTES`` of text (or one text,
where that is longer) and the arrays derived from it; nothing grows with the
number of rows of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
MULT = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def separator_table(word_bytes: np.ndarray) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.zeros(256, bool)
    table[word_bytes] = True
    return table


#: words ``[^\x20\x09-\x0D]+``
PLAIN = separator_table(np.array([b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D]))
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text whose A-Z are lower-cased
ALNUM = separator_table(
    np.array([b for b in range(256) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A])
)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_byte_values = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and its modular inverse for i below n (kept between calls)."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", MULT), ("down", INVERSE)):
            out = np.full(size, base)
            out[0] = 1
            _powers[name] = np.cumprod(out, dtype=np.uint64)
    return _powers["up"], _powers["down"]


@dataclass
class Texts:
    """A slice of a text column: its bytes and where each text starts."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than texts
    rows: pa.RecordBatch

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


@dataclass
class Words:
    """Words of a slice in order: byte ranges and the text each is in."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # index of the text
    first: np.ndarray  # for each text the index of its first word; one more


def texts_of(rows: pa.RecordBatch, column: str) -> Texts:
    values = rows.column(column)
    if pa.types.is_large_string(values.type):
        width = np.int64
    else:
        values, width = values.cast(pa.string()), np.int32
    if values.null_count:
        values = values.fill_null("")
    _, offsets, data = values.buffers()
    if len(values) == 0 or offsets is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64), rows)
    off = np.frombuffer(offsets, width)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[off[0] : off[-1]], off - off[0], rows)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The batches cut into runs of rows with about ``most`` bytes of text."""
    for batch in batches:
        whole = texts_of(batch, column)
        at = 0
        while at < len(whole):
            limit = whole.offsets[at] + most
            upto = max(at + 1, int(np.searchsorted(whole.offsets, limit, "right")) - 1)
            off = whole.offsets[at : upto + 1]
            yield Texts(whole.data[off[0] : off[-1]], off - off[0], batch.slice(at, upto - at))
            at = upto


def words_of(t: Texts, table: np.ndarray) -> Words:
    inside = table[t.data]
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True  # a text's start and end cut words
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before &= ~edge[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after &= ~edge[1:]
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, t.offsets)
    return Words(start, end, np.repeat(np.arange(len(t)), np.diff(first)), first)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``range_hash`` reads any range's hash from it."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * MULT)


def word_hashes(t: Texts, w: Words, lower: bool) -> np.ndarray:
    return range_hash(prefix_hash(LOWER[t.data] if lower else t.data), w.start, w.end)


def shingle_hashes(h: np.ndarray, w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of n words inside a text."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.text[:count] == w.text[n - 1 :])
    total = np.full(count, n, np.uint64)
    factor = MULT
    with np.errstate(over="ignore"):
        for j in range(n):
            total += h[j : j + count] * factor
            factor = factor * MULT
    return at, mix(total[at])


def short_hash(h: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence that is shorter than a shingle."""
    total = np.full(1, len(h), np.uint64)
    factor = MULT
    with np.errstate(over="ignore"):
        for x in h:
            total += x * factor
            factor = factor * MULT
    return mix(total)[0]


def starts_of_code_points(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80
