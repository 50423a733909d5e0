"""Best-fit packing of tokenised documents by bin-completion branch-and-bound.

Pieces are described by their lengths alone, so the search runs on the length
histogram, which has at most ``capacity`` rows however many documents there
are. The result is a list of patterns (a filling of one sequence, and how many
sequences use it). Spark then deals the pieces to the patterns: pieces of one
length are numbered, and the n-th piece of a length takes the n-th place that
the patterns hold for that length.

Bin completion: take the largest remaining length, enumerate all undominated
fillings of the space it leaves (least waste first, made only when asked for),
branch over them and over how often each is used. A branch ends as soon as its
waste exceeds what a solution better than the incumbent could waste. The
incumbent starts as the best-fit decreasing solution; its wasteful sequences
are solved anew, first alone, then with ever more full ones, at last all of
them. A search that ends tries everything, so its result is the fewest
sequences. One that visits ``nodes`` fillings stops, as the problem is NP-hard;
if the lower bound is not met then, a warning gives both figures. The solution
is always complete.

A document is the tokenizer's ids (no special tokens added; special-token
strings in a text are ordinary text) and the end id 1. NULL and empty texts
have the end id alone. Only documents longer than ``capacity`` are cut, into
pieces of ``capacity``; the last may be shorter. Repeated rows are packed one
by one. An empty table gives no pieces.
"""

from __future__ import annotations

import logging
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.rowwise import ROW, TEXT
from tessera.llm.scan import PLAIN, Texts, slices, word_hashes, words_of
from tessera.util import ensure_checkpoint_dir

log = logging.getLogger(__name__)

CAPACITY = 4096
END_ID = 1
#: fillings that a search visits: so many, or so many for every distinct length if that is more
SEARCH_NODES = 20_000
NODES_PER_LENGTH = 8
#: fillings per place of the quick try before the full one
FIRST_WIDTH = 4
#: words that a Python worker keeps the ids of; beyond it the memory starts anew
CACHED_WORDS = 1_000_000
#: pieces of one length that are numbered in one group, about
GROUP_ROWS = 200_000


# --- tokens -----------------------------------------------------------------


class WordIds:
    """Token ids per white-space separated word, remembered by word hash.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its words' ids one after the other.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.entry = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return at, known

    def entries(self, keys: np.ndarray, spell) -> np.ndarray:
        """Entry numbers of sorted distinct keys; ``spell(i)`` is the i-th word."""
        if len(self.keys) > CACHED_WORDS:
            self.clear()
        at, known = self.lookup(keys)
        new = np.flatnonzero(~known)
        if len(new):
            got = self.tokenizer.encode_batch_fast([spell(i) for i in new], add_special_tokens=False)
            got = [e.ids for e in got]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            entry = len(self.begin) - 1 + np.arange(len(new))
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
            flat = np.fromiter((x for e in got for x in e), np.uint32, int(sizes.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.entry = np.insert(self.entry, at[new], entry)
            self.keys = np.insert(self.keys, at[new], keys[new])
            at = np.searchsorted(self.keys, keys)
        return self.entry[at]

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and where each text's ids begin (one more)."""
        w = words_of(t, PLAIN)
        if not len(w.start):
            return np.zeros(0, np.uint32), np.zeros(len(t) + 1, np.int64)
        keys, sample, back = np.unique(word_hashes(t, w, False), return_index=True, return_inverse=True)
        raw = t.data.tobytes()
        entry = self.entries(keys, lambda i: raw[w.start[sample[i]] : w.end[sample[i]]].decode())[back]
        size = self.begin[entry + 1] - self.begin[entry]
        upto = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=upto[1:])
        ids = self.ids[np.repeat(self.begin[entry] - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[w.first]


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``_row``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``)."""
    src = docs.select(
        F.col(f"`{text}`").cast("string").alias(TEXT), F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW)
    )
    fields = [T.StructField(n, T.LongType(), False) for n in ("piece", "start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType(), False), False))
    schema = T.StructType([src.schema[ROW], *fields])
    types = to_arrow_schema(T.StructType(fields))

    def run(batches):
        enc = encoder(tokenizer)
        for part in slices(batches, TEXT):
            ids, begin = enc.encode(part)
            row, out = [], {f.name: [] for f in types}
            for k in range(len(part)):
                whole = np.append(ids[begin[k] : begin[k + 1]], np.uint32(END_ID)).astype("<u4")
                for p, start in enumerate(range(0, len(whole), capacity)):
                    cut = whole[start : start + capacity]
                    row.append(k)
                    values = (p, start, len(cut), zlib.crc32(cut), cut.tolist() if with_ids else None)
                    for f, v in zip(types, values):
                        out[f.name].append(v)
            columns = [part.rows.column(ROW).take(pa.array(row, pa.int64()))]
            columns += [pa.array(out[f.name], f.type) for f in types]
            yield pa.RecordBatch.from_arrays(columns, [ROW, *types.names])

    return src.mapInArrow(run, schema)


# --- search -----------------------------------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first
Pattern = tuple[Filling, int]  # a filling and how many sequences use it


class Stock:
    """The lengths that are left, with counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: v for k, v in counts.items() if v > 0}
        self.lengths = sorted(self.count)

    def take(self, filling: Filling, times: int) -> None:
        for length, n in filling:
            left = self.count[length] - n * times
            self.count[length] = left
            if not left:
                self.lengths.remove(length)

    def put(self, filling: Filling, times: int) -> None:
        for length, n in filling:
            if not self.count[length]:
                self.lengths.insert(bisect_right(self.lengths, length), length)
            self.count[length] += n * times

    def times(self, filling: Filling) -> int:
        return min(self.count[length] // n for length, n in filling)


def _filling(items: list[int]) -> Filling:
    return tuple((k, len(list(g))) for k, g in groupby(sorted(items, reverse=True)))


def best_fit(stock: Stock, capacity: int) -> Filling:
    """The largest length, completed by whatever fits best."""
    items, used, room = [], {}, capacity
    while True:
        i = bisect_right(stock.lengths, room) - 1
        while i >= 0 and used.get(stock.lengths[i], 0) >= stock.count[stock.lengths[i]]:
            i -= 1
        if i < 0:
            return _filling(items)
        x = stock.lengths[i]
        n = min(stock.count[x] - used.get(x, 0), room // x)
        items += [x] * n
        used[x] = used.get(x, 0) + n
        room -= n * x


def _sums(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """Bit sets of the sums up to ``room`` that the first i lengths can make, for every i."""
    mask, out = (1 << (room + 1)) - 1, [1]
    for x, c in zip(lengths, counts):
        r, c, k = out[-1], min(c, room // x), 1
        while c > 0 and r != mask:
            r |= (r << min(k, c) * x) & mask
            c, k = c - k, 2 * k
        out.append(r)
    return out


def fillings(stock: Stock, capacity: int, most_waste: int) -> Iterator[tuple[int, Filling | None]]:
    """All undominated fillings around the largest length as (waste, filling), least waste first.

    A filling is dominated if something left still fits, or if one of its
    lengths can be swapped for a larger one that is left. They are made one at
    a time; only sums that the lengths can make are followed. A
    dominated one gives None, so that a search can count it.
    """
    first = best_fit(stock, capacity)
    if sum(k * n for k, n in first) == capacity:
        yield 0, first
    largest = stock.lengths[-1]
    room = capacity - largest
    free = {x: stock.count[x] - (x == largest) for x in stock.lengths}
    lengths = [x for x in stock.lengths if x <= room and free[x]]
    sums = _sums(lengths, [free[x] for x in lengths], room)

    def dominated(chosen, waste):
        used = dict(chosen)
        left = lambda x: free[x] > used.get(x, 0)
        if any(left(x) for x in lengths[: bisect_right(lengths, waste)]):
            return True
        larger = lambda x: lengths[bisect_right(lengths, x) : bisect_right(lengths, x + waste)]
        return any(left(y) for x in used for y in larger(x))

    for waste in range(min(room, most_waste) + 1):
        stack = [(len(lengths), room - waste, ())]
        while stack:
            i, rest, chosen = stack.pop()
            if not sums[i] >> rest & 1:
                continue
            if rest:
                i = min(i, bisect_right(lengths, rest))
                x = lengths[i - 1]
                stack.append((i - 1, rest, chosen))
                stack += [(i - 1, rest - n * x, (*chosen, (x, n))) for n in range(1, min(free[x], rest // x) + 1)]
            elif waste and dominated(chosen, waste):
                yield waste, None
            else:
                whole = _filling([largest, *(x for x, n in chosen for _ in range(n))])
                if waste or whole != first:
                    yield waste, whole


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that no packing can do without (Martello and Toth's L2)."""
    total = sum(k * v for k, v in counts.items())
    best = -(-total // capacity)
    lengths = np.array(sorted(k for k, v in counts.items() if v > 0), np.int64)
    number = np.array([counts[int(k)] for k in lengths], np.int64)
    upto, size = np.append(0, np.cumsum(number)), np.append(0, np.cumsum(number * lengths))
    half = int(np.searchsorted(lengths, capacity // 2, "right"))
    for i in range(half + 1):  # lengths from the i-th on; those over half stand alone
        top = len(lengths) if i == half else int(np.searchsorted(lengths, capacity - lengths[i], "right"))
        room = (upto[top] - upto[half]) * capacity - (size[top] - size[half])
        over = max(0, -(-int(size[half] - size[i] - room) // capacity))
        best = max(best, int(upto[-1] - upto[half]) + over)
    return best


def _search(
    counts: dict[int, int], capacity: int, most: int, nodes: int, width: int | None
) -> tuple[list[Pattern] | None, int, bool]:
    """A packing in at most ``most`` sequences or None, the nodes left, and whether all were tried.

    With a ``width``, only so many fillings are tried at a place, each as often as it goes.
    """
    spare = most * capacity - sum(k * v for k, v in counts.items())
    if spare < 0:
        return None, nodes, True
    stock, path, wasted = Stock(counts), [], 0
    choices = lambda most_waste: islice(fillings(stock, capacity, most_waste), width)
    options = [choices(spare)]
    while options:
        choice = next(options[-1], None)
        if choice is not None:
            if nodes <= 0:
                return None, 0, False
            nodes -= 1
            waste, f = choice
            if f is None:
                continue
            n = stock.times(f)
            if waste:
                n = min(n, (spare - wasted) // waste)
            path.append((f, n, waste))
            stock.take(f, n)
            wasted += waste * n
            if not stock.lengths:
                return [(f, n) for f, n, _ in path], nodes, True
            options.append(choices(spare - wasted))
            continue
        options.pop()
        if path:  # the same filling once less, and another in its place
            f, n, waste = path.pop()
            back = n if width else 1
            stock.put(f, back)
            wasted -= waste * back
            if n > back:
                path.append((f, n - 1, waste))
                others = fillings(stock, capacity, spare - wasted)
                options.append(x for x in others if x[1] != path[-1][0])
    return None, nodes, width is None


def _some(patterns: list[Pattern], n: int) -> tuple[list[Pattern], list[Pattern]]:
    """About ``n`` sequences of the patterns, evenly, and the others."""
    total, taken, seen, rest = sum(m for _, m in patterns), [], 0, []
    for f, m in patterns:
        k = (seen + m) * n // total - seen * n // total
        seen += m
        taken += [(f, k)] if k else []
        rest += [(f, m - k)] if m > k else []
    return taken, rest


def _counts(patterns: list[Pattern]) -> dict[int, int]:
    out: dict[int, int] = {}
    for f, m in patterns:
        for length, n in f:
            out[length] = out.get(length, 0) + n * m
    return out


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY, nodes: int | None = None) -> list[Pattern]:
    """Patterns that together hold every length exactly as often as ``counts`` says."""
    stock, best = Stock(counts), []
    nodes = max(SEARCH_NODES, NODES_PER_LENGTH * len(stock.lengths)) if nodes is None else nodes
    while stock.lengths:
        f = best_fit(stock, capacity)
        best.append((f, stock.times(f)))
        stock.take(*best[-1])
    number = lambda patterns: sum(n for _, n in patterns)
    wasteful = lambda p: sum(k * n for k, n in p[0]) < capacity
    bound, again, proven = lower_bound(counts, capacity), 0, False
    width: int | None = FIRST_WIDTH
    while number(best) > bound and not proven and nodes > 0:
        # the wasteful sequences first, then with ever more full ones, at last all
        poor, full = [p for p in best if wasteful(p)], [p for p in best if not wasteful(p)]
        whole = again >= number(full)
        some, rest = ([], full) if not again else (full, []) if whole else _some(full, again)
        part = poor + some
        share = nodes if whole and width is None else max(1, nodes // 8)
        found, left, done = _search(_counts(part), capacity, number(part) - 1, share, width)
        nodes -= share - left
        if found:
            best, again, width = rest + found, 0, FIRST_WIDTH
        elif width is None:
            proven = whole and done
            again, width = max(2 * again, number(poor)), FIRST_WIDTH
        else:
            width = None
    if number(best) > bound and not proven:
        log.warning("packing: search budget spent at %d sequences, lower bound %d", number(best), bound)
    return best


# --- dealing ----------------------------------------------------------------


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the n-th piece of a length goes, as arrays ordered by (length, n).

    A pattern's item holds the pieces ``rank .. rank + times`` of its length:
    piece ``rank + i`` goes to sequence ``sequence + i`` at ``offset``.
    """
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in patterns:
        offset = 0
        for length, n in filling:
            for _ in range(n):
                rows.append((length, taken.get(length, 0), sequence, offset))
                taken[length] = taken.get(length, 0) + times
                offset += length
        sequence += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), columns.T))


def best_fit_pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    nodes: int | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    The tokenised pieces are checkpointed once. The driver sees the length
    histogram only (at most ``capacity`` rows); the places it sends back are
    bounded by the number of patterns, which depends on ``capacity`` and not on
    the number of documents. A length that holds a large part of all pieces
    (full pieces of long documents) is numbered in salted groups of about
    ``GROUP_ROWS`` rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    cut = pieces(docs, tokenizer, text, carry, capacity, with_ids).checkpoint()
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = spark.sparkContext.broadcast(places(pack_histogram(counts, capacity, nodes)))
    salts = max(8, max(counts.values(), default=0) // GROUP_ROWS)
    order = [F.col(f"{ROW}.`{c}`") for c in carry if c != text]
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("piece", "start", "ids_crc32", *order), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    group = Window.partitionBy("length", "_salt").orderBy("ids_crc32", "piece", *order)
    ranked = salted.withColumn("_rank", F.row_number().over(group).cast("long"))
    ranked = ranked.join(sizes, ["length", "_salt"]).select(*cut.columns, (F.col("_rank") + F.col("_before") - 1).alias("_rank"))
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def deal(batches):
        p = where.value
        key = p["length"] << 44 | p["rank"]
        for b in batches:
            rank = b.column("_rank").to_numpy()
            at = np.searchsorted(key, b.column("length").to_numpy() << 44 | rank, "right") - 1
            columns = [b.column(c) for c in schema.names[:-2]]
            columns += [pa.array(p["sequence"][at] + rank - p["rank"][at]), pa.array(p["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return ranked.mapInArrow(deal, schema)
