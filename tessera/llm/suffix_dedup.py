"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

A byte is removed where a string of ``length`` bytes over it also starts in a
document with a smaller id. Two suffixes need comparing on their first
``length`` bytes only, so the recursion of the difference-cover algorithm ends
after two levels:

1. *Sample.* Positions i with i mod 3 in {1, 2}. Their triples (three 8-byte
   characters, 24 bytes) are sorted over the cluster and named by rank.
2. *Recurse on names.* i + 24 is sampled where i is, so the pair of names at i
   and i + 24 stands for 48 bytes. The pairs are sorted and named again.
3. *Merge the rest.* For any two positions some shift d < 3 makes both i + d
   and j + d sampled (that is what the cover is for). A suffix is compared as
   (the d bytes before, the name at i + d, the bytes after up to ``length``);
   suffixes of each pair of residues meet at their own shift.
4. *Compare neighbours.* Suffixes that agree on all ``length`` bytes are
   neighbours in that order; each such run is reduced to its smallest document,
   and every start of a larger document is a repeated one.

Before the sort, positions that can't repeat are left out: in each window of
``length`` bytes the smallest 20-byte gram (by hash) is an anchor, equal windows
have equal anchors, so only windows whose anchor occurs in another text matter.
Equal texts are one text: copies with a larger id lose all bytes at once.

Texts are dealt to chunks of about 4 MB (a long text in pieces that share 49
bytes). A chunk sends its distinct keys to the buckets of their range, as blobs of
packed columns; a bucket sorts its keys and answers each blob in its order,
so no row is made for a position and a string that a third of all documents
share costs each chunk one key. Buckets grow in number with the input, and so
would a chunk's blobs, which each cost time however small: on large inputs up
to eight chunks of a task are a group, which sends a bucket one blob. Anchors
go by ranges of their hash, triples by quantiles of their first eight bytes
(distinct triples that share these stay in one bucket), pairs by their first
name's bucket. Merging (3) and the neighbours (4) are done in the bucket of a
pair. Between steps stand compressed tables in the shared folder, each deleted
once later steps don't read it, as are the shuffle files of each written table.

NULL and empty texts, and texts shorter than ``length``, lose nothing. Rows
with equal id and text give equal results; a NULL id counts as larger than all
others. Texts under one id, or under none, lose nothing to one another. Texts are read whole; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import ROW
from tessera.llm.scan import MULT, mix, powers, prefix_hash
from tessera.sinks.publish import delete_path
from tessera.util import ensure_checkpoint_dir, own_exchange, shared_scratch

LENGTH = 50
GRAM = 20
TRIPLE = 24
NO_ID = (1 << 63) - 1


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values."""
    out, span = x, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    n = len(x) - w + 1
    return np.minimum(out[:n], out[w - span : w - span + n])


def anchors(chunk: Chunk, length: int, size: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the smallest gram of every window of the pieces, ``size`` windows at a time."""
    w = length - GRAM + 1
    n = max(len(chunk.data) - length + 1, 0)
    inside = np.zeros(n, bool)
    for a, b in zip(chunk.start.tolist(), chunk.end.tolist()):
        inside[a : max(b - length + 1, a)] = True
    up, down = powers(size + length)
    edge = np.zeros(w - 1, np.uint32)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for x in range(0, n, size):
        prefix = prefix_hash(chunk.data[x : x + size + length - 1])
        m = len(prefix) - GRAM
        h = (prefix[GRAM:] - prefix[:m]) * down[:m]
        # grams are ordered by 32 bits (ties: all of them are anchors), 0 and the largest value left for marks
        short = np.clip((h * MULT >> np.uint64(32)).astype(np.uint32), 1, (1 << 32) - 2)
        low = sliding_min(short, w)
        low[~inside[x : x + size]] = 0
        # a gram is the minimum of some window if the largest of its windows' minima is itself
        reach = ~sliding_min(~np.concatenate([edge, low, edge]), w)
        at = np.flatnonzero(reach == short)
        found.append((at + x, mix(h[at] + MULT)))
    at, h = (np.concatenate(c) for c in zip(*found))
    at, one = np.unique(at, return_index=True)
    return at, h[one]


def text_key(text: str) -> Column:
    return F.xxhash64(F.col(text), F.octet_length(text))


#: Spark then deletes the shuffle files of a finished execution
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Written tables in the shared folder, for as long as a later step reads them."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def add(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_scratch(self.spark, name)
        self.paths.append(path)
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        """Delete all but the newest ``keep`` tables."""
        old = self.paths[: len(self.paths) - keep]
        for path in old:
            delete_path(self.spark, path)
        self.paths = self.paths[len(old) :]


#: bytes of a piece of a long text, and of the pieces that a task works on at a time
PIECE, CHUNK = 1 << 20, 1 << 22
CHUNKS = "c long, doc array<long>, k array<long>, base array<long>, size array<long>, data binary"
#: ``n`` keys of each chunk ``c`` of the group ``g``, a chunk's after another's
BLOBS = "bucket int, g long, c array<long>, n array<int>, blob binary"
#: bytes of keys that a task holds for its next blobs
HELD = 1 << 26
#: the bucket of what a chunk keeps for itself
OWN = -1


class Chunk:
    """Pieces of texts (``data`` is compressed), a zero byte after each: a piece of text ``doc``, ``k`` starts there at byte ``base``."""

    def __init__(self, rows: pa.Table | pa.RecordBatch):
        self.doc, self.k, self.base, size = (np.array(rows.column(x)[0].as_py(), np.int64) for x in ("doc", "k", "base", "size"))
        self.end = np.cumsum(size + 1) - 1
        if "data" in rows.schema.names:
            data = rows.column("data")[0].as_py()
            self.data = np.frombuffer(pa.Codec("zstd").decompress(data, int(self.end[-1]) + 1), np.uint8)
        self.start = self.end - size

    def piece(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, at, "right") - 1


def chunks(texts: DataFrame, length: int) -> DataFrame:
    """The texts dealt to chunks; pieces of a long text share ``length`` - 1 bytes, so each window is in one piece."""
    names = [part.split()[0] for part in CHUNKS.split(", ")]

    def emit(batches):
        from pyspark import TaskContext

        c, held, n = TaskContext.get().partitionId() << 32, [], 0

        def row():
            doc, k, base, data = zip(*held)
            sizes = [len(x) for x in data]
            joined = pa.Codec("zstd", 1).compress(b"\0".join([*data, b""]), asbytes=True)
            arrays = [pa.array([c]), *(pa.array([list(x)], pa.list_(pa.int64())) for x in (doc, k, base, sizes)), pa.array([joined])]
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            for doc, k, raw in zip(*(b.column(x).to_pylist() for x in ("doc", "k", "text"))):
                for at in range(0, len(raw) - length + 1, PIECE):
                    held.append((doc, k, at, raw[at : at + PIECE + length - 1]))
                    n += len(held[-1][3])
                    if n >= CHUNK:
                        yield row()
                        c, held, n = c + 1, [], 0
        if held:
            yield row()

    return texts.select("doc", "k", F.col("text").cast("binary").alias("text")).mapInArrow(emit, CHUNKS)


def pack(columns: Sequence[np.ndarray]) -> bytes:
    """Columns of 64 bits, the first as differences, byte planes compressed."""
    m = np.stack([c.astype(np.uint64, copy=False) for c in columns])
    m[0, 1:] -= m[0, :-1].copy()
    planes = np.ascontiguousarray(m.view(np.uint8).reshape(len(m), -1, 8).transpose(0, 2, 1))
    return pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpack(blob: bytes, n: int, columns: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob, n * columns * 8), np.uint8).reshape(columns, 8, n)
    m = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[..., 0]
    m[0] = np.cumsum(m[0], dtype=np.uint64)
    return m


def distinct(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of every distinct key one row, in the order of the first column, and each row's place among these."""
    h = columns[-1]
    for c in columns[-2::-1]:
        h = mix(h * MULT + c)
    order = np.argsort(h)
    new = _changes([h], order)
    if (_changes(columns, order) != new).any():  # two keys with one hash
        order = np.lexsort(columns[::-1])
        new = _changes(columns, order)
    first = order[new]
    by = np.argsort(columns[0][first])
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    inverse = np.empty(len(order), np.int64)
    inverse[order] = place[np.cumsum(new) - 1]
    return first[by], inverse


def _changes(columns: Sequence[np.ndarray], order: np.ndarray) -> np.ndarray:
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return new


def in_order(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their columns, and which of them differ from the one before; only ties look at the next column."""
    order = np.argsort(columns[0])
    new = _changes(columns[:1], order)
    for c in columns[1:]:
        tied = ~new
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        rows = order[at]
        by = np.argsort(c[rows])
        rank = np.empty(len(rows), np.int64)
        rank[by] = np.cumsum(_changes([c[rows]], by))
        by = np.argsort(np.cumsum(new[at]) << 32 | rank)
        order[at] = rows[by]
        new[at] |= _changes([c], order[at])
    return order, new


def group_bits(chunks: int) -> int:
    """2 to this power chunks at most are a group: one each while there are few, so that tasks stay even."""
    return min((chunks >> 8).bit_length(), 3)


def dealt(g: int, asked: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    """One row a bucket, of chunks of a group: each chunk, the buckets of its keys (they ascend) and the keys."""
    buckets = np.unique(np.concatenate([b[np.flatnonzero(np.diff(b, prepend=-1))] for _, b, _ in asked]))
    cuts = [np.searchsorted(b, [buckets, buckets + 1]).tolist() for _, b, _ in asked]
    rows = []
    for i, bucket in enumerate(buckets.tolist()):
        parts = [(c, keys[:, lo[i] : hi[i]]) for (c, _, keys), (lo, hi) in zip(asked, cuts) if lo[i] < hi[i]]
        c, keys = zip(*parts)
        rows.append((bucket, g, c, [x.shape[1] for x in keys], pack(np.concatenate(keys, axis=1))))
    return _table(rows, _BLOBS)


_BLOBS = pa.schema([("bucket", pa.int32()), ("g", pa.int64()), ("c", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("blob", pa.binary())])


def _table(rows: list, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def asked(chunks, bits: int, ask):
    """Tables of blobs; ``ask`` gives the buckets and the columns of a chunk's keys."""
    held, size = [], 0
    for rows in chunks:
        c = rows.column("c")[0].as_py()
        if held and (held[0][0] >> bits != c >> bits or size >= HELD):
            yield dealt(held[0][0] >> bits, held)
            held, size = [], 0
        buckets, columns = ask(rows)
        held.append((c, buckets, np.stack([x.astype(np.uint64, copy=False) for x in columns])))
        size += held[-1][2].nbytes
    if held:
        yield dealt(held[0][0] >> bits, held)


def asking(bits: int, ask):
    def emit(batches):
        for table in asked((b.slice(i, 1) for b in batches for i in range(b.num_rows)), bits, ask):
            yield from table.to_batches()

    return emit


def answered(blobs: DataFrame, columns: int, answer) -> DataFrame:
    """Per blob the column that ``answer`` makes of all keys of its bucket."""

    def reply(rows: pa.Table) -> pa.Table:
        n = [sum(x) for x in rows.column("n").to_pylist()]
        ends = np.cumsum(n)
        keys = np.empty((columns, sum(n)), np.uint64)
        for blob, size, e in zip(rows.column("blob"), n, ends):
            keys[:, e - size : e] = unpack(blob.as_py(), size, columns)
        got = answer(keys)
        out = [pack([got[e - size : e]]) for e, size in zip(ends, n)]
        return pa.Table.from_arrays([*(rows.column(x).combine_chunks() for x in _BLOBS.names[:-1]), pa.array(out, pa.binary())], schema=_BLOBS)

    return blobs.groupBy("bucket").applyInArrow(reply, BLOBS)


class Replies:
    """The answers to a group's chunks."""

    def __init__(self, rows: pa.Table):
        self.parts: dict[int, list] = {}
        for bucket, c, n, blob in sorted(zip(*(rows.column(x).to_pylist() for x in ("bucket", "c", "n", "blob")))):
            answers, at = unpack(blob, sum(n), 1)[0], 0
            for one, size in zip(c, n):
                self.parts.setdefault(one, []).append((bucket, answers[at : at + size]))
                at += size

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """The answers to a chunk's keys in their order, and the bucket of each; once only."""
        parts = self.parts.pop(c, [(0, np.zeros(0, np.uint64))])
        buckets, answers = zip(*parts)
        return np.concatenate(answers), np.repeat(np.array(buckets, np.uint64), [len(x) for x in answers])


def per_group(table: DataFrame, answers: DataFrame, bits: int, work, schema: str) -> DataFrame:
    """The tables that ``work`` makes of a group's chunks, one row each, and its blobs."""

    def whole(rows: pa.Table, blobs: pa.Table) -> pa.Table:
        rows = rows.drop_columns("g")
        return pa.concat_tables(work([rows.slice(i, 1) for i in range(rows.num_rows)], blobs))

    group = F.shiftright("c", bits).alias("g")
    return table.select(group, "*").groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(whole, schema)


def shared_keys(keys: np.ndarray) -> np.ndarray:
    """1 for each hash that two pieces have; the second column tells that a chunk has it in two."""
    order = np.argsort(keys[0])
    new = _changes(keys[:1], order)
    many = np.add.reduceat(keys[1][order] + np.uint64(1), np.flatnonzero(new)) > 1
    out = np.empty(keys.shape[1], np.uint64)
    out[order] = many[np.cumsum(new) - 1]
    return out


def named(keys: np.ndarray) -> np.ndarray:
    """Ranks of the triples, times two, plus 1 where the triple stands in two places."""
    order, new = in_order(keys[:3])
    many = np.add.reduceat(keys[3][order] + np.uint64(1), np.flatnonzero(new)) > 1
    rank = np.cumsum(new) - 1
    out = np.empty(keys.shape[1], np.uint64)
    out[order] = rank * 2 + many[rank]
    return out


def merged(keys: np.ndarray) -> np.ndarray:
    """Pairs are named by rank; bit d: the window d bytes before also starts in a smaller document."""
    order, new = in_order(keys[:2])
    name = np.empty(keys.shape[1], np.uint64)
    name[order] = np.cumsum(new)
    around, doc = keys[2] >> np.uint64(3), keys[3].view(np.int64)
    out = np.zeros(keys.shape[1], np.uint64)
    for d in range(3):
        at = np.flatnonzero(keys[2] & np.uint64(1 << d))
        if not len(at):
            continue
        key = name[at] << np.uint64(16) | (around[at] >> np.uint64(8 * d) & np.uint64(0xFFFF))
        order = np.argsort(key)
        new = _changes([key], order)
        least = np.minimum.reduceat(doc[at][order], np.flatnonzero(new))
        out[at[order]] |= (doc[at][order] > least[np.cumsum(new) - 1]).astype(np.uint64) << np.uint64(d)
    return out


def regions_of(at: np.ndarray, length: int, start=0, end=None) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows that hold one of the ascending anchors begin and end, those that touch as one; an anchor's piece is from ``start`` to ``end``."""
    lo, hi = np.maximum(at - (length - GRAM), start), np.minimum(at + length, end)
    new = np.ones(len(at) + 1, bool)
    new[1:-1] = lo[1:] > hi[:-1]
    return lo[new[:-1]], hi[new[1:]]


def covered(data: np.ndarray, at: np.ndarray, length: int, start=0, end=None) -> np.ndarray:
    """The bytes of windows that hold an anchor; its piece, all of the data by default, is from ``start`` to ``end``."""
    lo, hi = regions_of(at, length, start, len(data) if end is None else end)
    cover = np.zeros(len(data) + 1, np.int8)
    cover[lo] = 1
    cover[hi] = -1
    return np.cumsum(cover[:-1], dtype=np.int8).view(bool)


#: positions that a task works on at a time
SLICE = 1 << 17


def sampled_places(data: np.ndarray, at: np.ndarray, length: int, size: int = SLICE, start=0, end=None):
    """Sampled positions around the anchors ``at`` with the ends of their region, some at a time."""
    lo, hi = regions_of(at, length, start, len(data) if end is None else end)
    ends = np.cumsum(np.maximum(hi - lo - TRIPLE + 1, 0))  # of the places of each region, as they follow one another
    shift = hi - TRIPLE + 1 - ends
    for a in range(0, int(ends[-1]) if len(ends) else 0, size):
        i = np.arange(a, min(a + size, ends[-1]))
        region = np.searchsorted(ends, i, "right")
        j = i + shift[region]
        one = j % 3 != 0
        if one.any():
            region = region[one]
            yield j[one], lo[region], hi[region]


def every(data: np.ndarray, kind: str) -> np.ndarray:
    """The number of that kind at each byte."""
    return np.ndarray(len(data) - np.dtype(kind).itemsize + 1, kind, np.ascontiguousarray(data), strides=(1,))


class Sample:
    """Sampled positions of a chunk's candidate regions with their triples.

    ``shifts`` has bit d where the window starting at j - d lies in the region;
    ``around`` is the two bytes before and the two after the 48 bytes.
    """

    def __init__(self, chunk: Chunk, at: np.ndarray, length: int):
        piece = chunk.piece(at)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint8))]
        for j, lo, hi in sampled_places(chunk.data, at, length, SLICE, chunk.start[piece], chunk.end[piece]):
            ok = [((j - d >= lo) & (j - d + length <= hi)).astype(np.uint8) << np.uint8(d) for d in range(3)]
            found.append((j, ok[0] | ok[1] | ok[2]))
        j, shifts = (np.concatenate(x) for x in zip(*found))
        self.j, self.shifts = j, shifts.astype(np.uint64)
        data = np.concatenate([np.zeros(2, np.uint8), chunk.data, np.zeros(length, np.uint8)])
        eight, two = every(data, ">u8"), every(data, ">u2")
        self.triple = [eight[j + x].astype(np.uint64) for x in (2, 10, 18)]
        self.around = two[j].astype(np.uint64) << np.uint64(16) | two[j + 50]
        self.first, self.place = distinct(self.triple)

    def pairs(self, name: np.ndarray, bucket: np.ndarray, chunk: Chunk):
        """The positions whose pair of names can repeat, their document, the pairs' keys and the distinct keys."""
        name = (bucket << np.uint64(40) | name)[self.place]
        at = np.zeros(len(chunk.data) + TRIPLE, np.uint64)
        at[self.j] = name
        after = at[self.j + TRIPLE]
        keep = np.flatnonzero((name & after & np.uint64(1) != 0) & (self.shifts != 0))
        keys = [name[keep], after[keep], self.around[keep] << np.uint64(3) | self.shifts[keep]]
        doc = chunk.doc[chunk.piece(self.j[keep])]
        first, place = distinct(keys)
        least = np.full(len(first), NO_ID)
        np.minimum.at(least, place, doc)
        return keep, doc, keys, first, place, least


def _anchors_of(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(rows.column("at")[0].as_py(), np.int32).astype(np.int64)


def repeated_spans(texts: DataFrame, length: int, tables: Tables) -> DataFrame:
    """(doc, k, spans): what first copies lose, as ends of runs; once a piece."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = tables.add(chunks(texts, length), "chunks")
    total = whole.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0]
    parts = max(parts, (total or 0) // CHUNK)  # buckets
    bits = group_bits((total or 0) // CHUNK)
    width = np.uint64((1 << 64) // parts + 1)

    def anchored(chunk):
        at, h = anchors(chunk, length)
        order = np.argsort(h, kind="stable")
        new = _changes([h], order)
        return at, h, order, new

    def ask_anchors(rows):
        chunk = Chunk(rows)
        at, h, order, new = anchored(chunk)
        piece = chunk.piece(at)[order]
        starts = np.flatnonzero(new)
        several = piece[starts] != piece[np.append(starts[1:], len(h)) - 1]
        keys = h[order][starts]
        return (keys // width).astype(np.int64), [keys, several]

    flags = tables.add(answered(whole.mapInArrow(asking(bits, ask_anchors), BLOBS), 2, shared_keys), "flags")
    regions_schema = CHUNKS + ", at binary, probe array<long>"

    def keep_shared(rows: pa.Table, flag: np.ndarray) -> pa.Table:
        chunk = Chunk(rows)
        at, _, order, new = anchored(chunk)
        hit = np.zeros(len(at), bool)
        hit[order] = flag[np.cumsum(new) - 1] > 0 if len(at) else False
        at = at[hit]
        some = at[:: len(at) // 256 + 1]
        spread = np.clip(some - np.arange(len(some)) * 7 % 31, 0, None)
        probe = every(np.append(chunk.data, np.zeros(8, np.uint8)), ">u8")[spread].astype(np.uint64) ^ np.uint64(1 << 63)
        near = covered(chunk.data, at, length, chunk.start[chunk.piece(at)], chunk.end[chunk.piece(at)])
        data = pa.Codec("zstd", 1).compress(np.where(near, chunk.data, np.uint8(0)), asbytes=True)  # the regions' bytes
        rows = rows.set_column(rows.schema.get_field_index("data"), "data", pa.array([data], pa.binary()))
        return rows.append_column("at", pa.array([at.astype(np.int32).tobytes()], pa.binary())).append_column(
            "probe", pa.array([probe.view(np.int64).tolist()], pa.list_(pa.int64()))
        )

    def shared(chunks, flags):
        got = Replies(flags)
        for rows in chunks:
            yield keep_shared(rows, got.take(rows.column("c")[0].as_py())[0])

    regions = tables.add(per_group(whole, flags, bits, shared, regions_schema), "regions")
    tables.drop(keep=1)
    cuts = [i / parts for i in range(1, parts)]
    probes = regions.select(F.explode("probe").alias("x"))
    bounds = probes.agg(F.percentile_approx("x", cuts, 10 * parts)).first()[0] if cuts else []
    bounds = np.unique(np.array(bounds or [], np.int64).view(np.uint64) ^ np.uint64(1 << 63))
    regions = regions.drop("probe")

    def ask_names(start, end):
        def ask(rows):
            s = Sample(Chunk(rows), _anchors_of(rows), length)
            keys = [x[s.first] for x in s.triple]
            several = np.bincount(s.place, minlength=len(s.first)) > 1
            buckets = np.searchsorted(bounds, keys[0], "right")
            a, b = np.searchsorted(buckets, [start, end])
            return buckets[a:b], [x[a:b] for x in (*keys, several)]

        return asking(bits, ask)

    # the triples are the most that is on disk at once: on large inputs the two halves of the buckets get them in turn
    turns = [0, len(bounds) + 1] if not bits else [0, (len(bounds) + 1) // 2, len(bounds) + 1]
    names = [tables.add(answered(regions.mapInArrow(ask_names(*turn), BLOBS), 4, named), "names") for turn in zip(turns, turns[1:])]
    names = names[0] if len(names) == 1 else names[0].unionByName(names[1])

    def ask_pairs(chunks, names):
        got, kept = Replies(names), []

        def ask(rows):
            chunk, c = Chunk(rows), rows.column("c")[0].as_py()
            sample = Sample(chunk, _anchors_of(rows), length)
            keep, doc, keys, first, place, least = sample.pairs(*got.take(c), chunk)
            keys = [x[first] for x in keys]
            larger = (doc > least[place]).astype(np.uint64) << np.uint64(3)
            order = np.argsort(sample.j[keep])
            own = [x[order].astype(np.uint64) for x in (sample.j[keep], place, larger | sample.shifts[keep])]
            kept.append((OWN, c >> bits, [c], [len(keep)], pack(own)))
            return (keys[0] >> np.uint64(40)).astype(np.int64), [*keys, least.view(np.uint64)]

        yield from asked(chunks, bits, ask)
        yield _table(kept, _BLOBS)

    pairs = tables.add(per_group(regions, names, bits, ask_pairs, BLOBS), "pairs")
    pieces = tables.add(regions.select("c", "doc", "k", "base", "size"), "pieces")
    tables.drop(keep=2)
    runs = tables.add(answered(pairs.where(F.col("bucket") != OWN), 4, merged), "runs")
    both = runs.unionByName(pairs.where(F.col("bucket") == OWN))

    def spans(rows: pa.Table, own: tuple[int, bytes], bits: np.ndarray) -> pa.Table:
        chunk = Chunk(rows)
        j, place, flags = unpack(own[1], own[0], 3)
        j = j.astype(np.int64)
        bits = np.where(flags > 7, np.uint64(7), bits[place.astype(np.int64)] if len(bits) else np.uint64(0)) & flags
        starts = np.concatenate([j[bits & np.uint64(1 << d) != 0] - d for d in range(3)])
        ends = removed_spans(starts, length)
        piece = chunk.piece(ends[:, 0])
        ends = ends + (chunk.base - chunk.start)[piece][:, None]
        cuts = np.flatnonzero(np.diff(piece, prepend=-1))
        found = [(int(chunk.doc[piece[x]]), int(chunk.k[piece[x]]), ends[x:y].ravel()) for x, y in zip(cuts, [*cuts[1:], len(ends)])]
        return _table(found, pa.schema([("doc", pa.int64()), ("k", pa.int64()), ("spans", pa.list_(pa.int64()))]))

    def all_spans(chunks, both):
        is_own = pa.compute.equal(both.column("bucket"), OWN)
        own = both.filter(is_own)
        own = {c[0]: (n[0], blob) for c, n, blob in zip(*(own.column(x).to_pylist() for x in ("c", "n", "blob")))}
        got = Replies(both.filter(pa.compute.invert(is_own)))
        for rows in chunks:
            c = rows.column("c")[0].as_py()
            yield spans(rows, own[c], got.take(c)[0])

    return per_group(pieces, both, bits, all_spans, "doc long, k long, spans array<long>")


def removed_spans(starts: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs [start, end) covered by windows at the given starts."""
    s = np.sort(starts)
    if not len(s):
        return np.zeros((0, 2), np.int64)
    new = np.flatnonzero(np.concatenate([[True], s[1:] > s[:-1] + length]))
    return np.stack([s[new], s[np.append(new[1:], len(s)) - 1] + length], 1)


def joined_spans(spans: np.ndarray) -> np.ndarray:
    """Spans that touch or overlap, as one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    if len(spans) < 2:
        return spans
    new = np.append(True, spans[1:, 0] > spans[:-1, 1])
    return np.stack([spans[new, 0], spans[np.append(np.flatnonzero(new)[1:], len(spans)) - 1, 1]], 1)


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(SPAN)),
    T.StructField("kept_sha256", T.StringType()),
]


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ("doc_id",), length: int = LENGTH
) -> DataFrame:
    """``_row`` (struct of ``carry``), ``n_bytes``, ``n_removed``, ``spans`` (bytes) and ``kept_sha256`` per row."""
    if length != LENGTH:
        raise ValueError("the names of 48 bytes and two more bytes make 50")
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).withColumn("t", text_key("text"))
    firsts = rows.groupBy("t").agg(F.min("doc").alias("first")).checkpoint()
    # Of an id with several texts, and of the rows without one, the text's key tells them apart (else 0).
    several = firsts.groupBy("first").count().where("count > 1").select("first", F.lit(True).alias("several"))
    firsts = firsts.join(own_exchange(several), "first", "left").select("t", "first", F.when(F.col("several"), F.col("t")).otherwise(0).alias("k"))
    firsts = firsts.checkpoint()
    tables = Tables(docs.sparkSession)
    texts = rows.select("doc", "t", "text").join(firsts.withColumnRenamed("first", "doc"), ["t", "doc"]).dropDuplicates(["t", "doc"])
    starts = repeated_spans(texts, length, tables)
    starts = starts.groupBy("doc", "k").agg(F.flatten(F.collect_list("spans")).alias("starts")).checkpoint()
    tables.drop()
    known = firsts.join(starts.withColumnRenamed("doc", "first"), ["first", "k"], "left").select("t", "first", "starts")
    joined = rows.join(known, "t")
    schema = T.StructType([joined.schema[ROW], *FIELDS])

    def finish(batches):
        for b in batches:
            out = {f.name: [] for f in FIELDS}
            columns = (b.column(c).to_pylist() for c in ("text", "doc", "first", "starts"))
            for text_, doc, first, starts_ in zip(*columns):
                raw = text_.encode()
                if doc > first:
                    spans = np.array([[0, len(raw)]]) if len(raw) >= length else np.zeros((0, 2), np.int64)
                else:
                    spans = joined_spans(np.array(starts_ or (), np.int64).reshape(-1, 2))
                kept = hashlib.sha256()
                at = 0
                for start, end in spans:
                    kept.update(raw[at:start])
                    at = end
                kept.update(raw[at:])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int((spans[:, 1] - spans[:, 0]).sum()))
                out["spans"].append([{"start": int(x), "end": int(y)} for x, y in spans])
                out["kept_sha256"].append(kept.hexdigest())
            arrays = [pa.array(out[f.name], t.type) for f, t in zip(FIELDS, list(_arrow)[1:])]
            yield pa.RecordBatch.from_arrays([b.column(ROW), *arrays], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    _arrow = to_arrow_schema(schema)
    return joined.select(ROW, "text", "doc", "first", "starts").mapInArrow(finish, schema)
