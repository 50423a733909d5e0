"""N-gram Jaccard self-join with rare-first prefix filtering.

A text's set holds its distinct word n-grams (lower-cased A-Z; a text of fewer
words is one n-gram, a text without words has no set and links with nothing).
Two texts link when intersection / union >= num / den, compared in integers.

Plan, with every step linear in the n-grams or in the links:

1. Frequencies of all n-grams are counted into a fixed table by hash (each task
   counts its rows; the tables are added up by Spark). Their order, rare first,
   is only a global order: any total order gives the same links.
2. Equal sets become one class (a 64-bit fingerprint of the set).
3. A class's prefix (n - ceil(t n) + 1 rarest n-grams) is shuffled by n-gram.
   Each n-gram's list of classes yields candidate pairs: all pairs of a short
   list; of a longer one the pairs with its centre, the class with the fewest
   rare n-grams. Length, positional and suffix filters drop pairs that can't
   link.
   The suffix filter works on the sizes of parts of the sets: the parts that differ
   bound the union from below, whatever the sets hold.
4. Distinct candidates are verified once on their whole sets.
5. Members of a long list are compared with one another, block by block, so
   that no link is lost. Without ``count_links`` only members that the centre's
   links have not brought together are compared, which is enough for the
   components, and ``n_links`` is left out.
6. Links and classes become components. ``n_links`` counts every link of a
   row's class to another class; a group of k near copies has up to k (k - 1) / 2
   links, and counting them verifies each.

N-grams and fingerprints are 64-bit hashes; sets are compared on 48 bits. A long list is streamed: one
task holds its centre and one batch. Repeated rows count as copies; a NULL id
gets the id of its component, or NULL if no member of that has one. Only doc_id
and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.components import connected_components
from tessera.llm.rowwise import annotate_whole
from tessera.llm.scan import MULT, PLAIN, Texts, mix, shingle_hashes, short_hash, slices, word_hashes, words_of
from tessera.util import ensure_checkpoint_dir, own_exchange

BITS = 18  # of the frequency table
SEGMENTS = 16
SHORT_LIST = 8
BLOCK = 1024
PARTS = 512
#: ids that may be broadcast; more are joined by shuffle
BROADCAST_IDS = 200_000


def sets_of(t: Texts, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text of a slice."""
    w = words_of(t, PLAIN)
    h = word_hashes(t, w, True) if len(w.start) else np.zeros(0, np.uint64)
    at, grams = shingle_hashes(h, w, n)
    first = np.searchsorted(at, w.first)
    out = []
    for k in range(len(t)):
        own = grams[first[k] : first[k + 1]]
        words = w.first[k + 1] - w.first[k]
        if 0 < words < n:
            own = short_hash(h[w.first[k] : w.first[k + 1]]).reshape(1)
        out.append(np.unique(own))
    return out


def fingerprint(s: np.ndarray) -> int:
    """Equal sets have equal fingerprints, as a signed 64-bit number."""
    return int(mix(np.array([len(s)], np.uint64) + mix(s ^ MULT).sum(dtype=np.uint64))[0].astype(np.int64))


def _place(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BITS)).astype(np.int64)


def frequency_ranks(texts: DataFrame, n: int) -> np.ndarray:
    """Rank by n-gram frequency for every place of the fixed table."""
    schema = "segment int, counts binary"

    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for t in slices(batches, "_text"):
            w = words_of(t, PLAIN)
            if len(w.start):
                _, grams = shingle_hashes(word_hashes(t, w, True), w, n)
                total += np.bincount(_place(grams), minlength=1 << BITS)
        parts = [x.astype("<i8").tobytes() for x in np.split(total, SEGMENTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(parts, pa.binary())], ["segment", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[s] = total.get(s, 0) + np.frombuffer(c, "<i8")
        parts = [x.astype("<i8").tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(parts, pa.binary())], ["segment", "counts"])

    summed = texts.select("_text").mapInArrow(count, schema).repartition(SEGMENTS, "segment").mapInArrow(add, schema)
    counts = np.zeros((SEGMENTS, (1 << BITS) // SEGMENTS))
    for r in summed.collect():  # SEGMENTS rows, 2 MB in all
        counts[r["segment"]] = np.frombuffer(r["counts"], "<i8")
    return (np.log2(1 + counts.ravel()) * 1024).astype(np.uint16)


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _sketch(s: np.ndarray) -> int:
    """Sizes of eight parts of the set, one byte each (255: so many or more)."""
    part = np.bincount((s & np.uint64(7)).astype(np.int64), minlength=8)
    return int(np.minimum(part, 255).astype(np.uint8).view(np.int64)[0])


POSTING = "token long, centre long, node long, n long, pos long, sketch long"


def postings(texts: DataFrame, n: int, num: int, den: int, ranks) -> DataFrame:
    """The prefix n-grams of every class; a task lists a class once, copies add nothing."""
    names = [f.split()[0] for f in POSTING.split(", ")]

    def emit(batches):
        seen: set[int] = set()
        rank = ranks.value
        for t in slices(batches, "_text"):
            parts = []
            for s in sets_of(t, n):
                if not len(s) or (node := fingerprint(s)) in seen:
                    continue
                if len(seen) < 100_000:  # a bound on memory; later copies only repeat rows
                    seen.add(node)
                r = rank[_place(s)]
                order = np.argsort(r, kind="stable")[: prefix_length(len(s), num, den)]
                centre = 65535 - int(r[order].mean())
                p = len(order)
                row = np.array([centre, node, len(s), 0, _sketch(s)], np.int64)
                part = np.empty((6, p), np.int64)
                part[0], part[1:], part[4] = s[order].astype(np.int64), row[:, None], np.arange(p)
                parts.append(part)
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(parts, 1)], names)

    return texts.select("_text").mapInArrow(emit, POSTING)


def may_link(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Length, positional and suffix filter on rows (n, pos, sketch) of two classes."""
    na, nb = a[0], b[0]
    need = -(-num * (na + nb) // (num + den))
    ok = den * np.minimum(na, nb) >= num * np.maximum(na, nb)
    ok &= 1 + np.minimum(na - a[1], nb - b[1]) - 1 >= need
    parts = lambda x: np.ascontiguousarray(x[2]).view(np.uint8).reshape(-1, 8).astype(np.int64)
    ok[ok] = np.abs(parts(a[:, ok]) - parts(b[:, ok])).sum(1) <= (na + nb - 2 * need)[ok]
    return ok


FOUND = "kind int, a long, b long, n long, pos long, sketch long"


def _candidates(num: int, den: int):
    """Rows of sorted posting lists to pairs (kind 0) and members of long lists (kind 1: token, node)."""
    names = [f.split()[0] for f in FOUND.split(", ")]

    def batch(kind, a, b, rest):
        k = pa.array(np.full(len(a), kind, np.int32))
        return pa.RecordBatch.from_arrays([k, *[pa.array(np.ascontiguousarray(x)) for x in (a, b, *rest)]], names)

    def pairs(x, y):
        ok = may_link(x[3:], y[3:], num, den) & (x[2] != y[2])
        a, b = np.minimum(x[2], y[2])[ok], np.maximum(x[2], y[2])[ok]
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        return batch(0, a, b, np.zeros((3, len(a)), np.int64))

    def whole_lists(rows):
        """All rows of lists that are complete."""
        start = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
        size = np.diff(np.append(start, rows.shape[1]))
        at = np.arange(rows.shape[1]) - np.repeat(start, size)
        size_of = np.repeat(size, size)
        short = np.flatnonzero((size_of > 1) & (size_of <= SHORT_LIST))
        for step in range(1, SHORT_LIST):
            i = short[at[short] + step < size_of[short]]
            if len(i):
                yield pairs(rows[:, i], rows[:, i + step])
        long = np.flatnonzero(size_of > SHORT_LIST)
        if len(long):
            rest = long[at[long] > 0]
            yield pairs(rows[:, rest - at[rest]], rows[:, rest])
            yield batch(1, rows[0, long], rows[2, long], rows[3:, long])

    def run(batches):
        open_rows, centre, last = np.empty((6, 0), np.int64), None, None
        for b in batches:
            rows = np.stack([b.column(i).to_numpy() for i in range(6)])
            if not rows.shape[1]:
                continue
            same = np.zeros(rows.shape[1], bool)
            same[1:] = (rows[0, 1:] == rows[0, :-1]) & (rows[2, 1:] == rows[2, :-1])
            same[0] = last is not None and rows[0, 0] == last[0] and rows[2, 0] == last[1]
            last = (rows[0, -1], rows[2, -1])
            rows = rows[:, ~same]
            if not rows.shape[1]:
                continue
            if centre is not None:  # inside a long list: only its centre is kept
                upto = int(np.searchsorted(rows[0] != centre[0, 0], True))
                more, rows = rows[:, :upto], rows[:, upto:]
                if more.shape[1]:
                    yield pairs(np.repeat(centre, more.shape[1], 1), more)
                    yield batch(1, more[0], more[2], more[3:])
                if not rows.shape[1]:
                    continue
                centre = None
            rows = np.concatenate([open_rows, rows], 1)
            tail = int(np.flatnonzero(rows[0] == rows[0, -1])[0])
            done, open_rows = rows[:, :tail], rows[:, tail:]
            if done.shape[1]:
                yield from whole_lists(done)
            if open_rows.shape[1] > SHORT_LIST:
                yield from whole_lists(open_rows)
                centre, open_rows = open_rows[:, :1], open_rows[:, :0]
        if open_rows.shape[1]:
            yield from whole_lists(open_rows)

    return run


PAIRS_AT_ONCE = 200_000
MEMBER = "token long, one long, two long, n long, node long, component long, pos long, sketch long, block long"


def _across_block(rows: np.ndarray, num: int, den: int) -> np.ndarray:
    """Candidate pairs of different components among members ordered by n (columns from n on)."""
    size = rows.shape[1]
    apart = rows[5].min() < rows[5].max()
    # a pair's longer set is at most den / num times the shorter one
    last = np.searchsorted(rows[0], den * rows[0] // num, "right")
    width = last - np.arange(size) - 1
    upto, out, i = np.cumsum(width), [], 0
    while i < size:
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS_AT_ONCE, "right")))
        x = np.repeat(np.arange(i, j), width[i:j])
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(width[i:j]) - width[i:j], width[i:j])
        ok = rows[2, x] != rows[2, y]
        if apart:
            ok &= rows[5, x] != rows[5, y]
        x, y = x[ok], y[ok]
        side = lambda z: np.stack([rows[0, z], rows[3, z], rows[4, z]])
        ok = may_link(side(x), side(y), num, den)
        out.append(np.stack([rows[1, x[ok]], rows[1, y[ok]]]))
        i = j
    return np.sort(np.concatenate(out, 1), axis=0)


def _across(num: int, den: int):
    """Candidate pairs within block pairs of long lists; rows come sorted by token, one, two and n."""

    def pairs(rows):
        cut = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(0)) + 1
        found = [_across_block(part[3:], num, den) for part in np.split(rows, cut, axis=1)]
        both = np.unique(np.concatenate(found, 1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in both], ["a", "b"])

    def run(batches):
        held = np.empty((9, 0), np.int64)  # at most a block pair and a batch
        for b in batches:
            if not b.num_rows:
                continue
            held = np.concatenate([held, np.stack([c.to_numpy() for c in b.columns])], 1)
            tail = int(np.flatnonzero((held[:3] == held[:3, -1:]).all(0))[0])
            if tail:
                yield pairs(held[:, :tail])
                held = held[:, tail:]
        if held.shape[1]:
            yield pairs(held)

    return run


def _wide_sketch(s: np.ndarray, parts: int) -> bytes:
    """Sizes of that many parts of the set, one byte each (255: so many or more)."""
    part = np.bincount((s >> np.uint64(3) & np.uint64(parts - 1)).astype(np.int64), minlength=parts)
    return np.minimum(part, 255).astype(np.uint8).tobytes()


def _packed(s: np.ndarray) -> bytes:
    """The sorted set as 48-bit numbers: enough to compare two sets, a quarter less to move."""
    return (s >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()


def sketched(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that the suffix filter on the classes' wide sketches lets through."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")

    def run(batches):
        for x in batches:
            if not x.num_rows:
                continue
            na, nb = (x.column(c).to_numpy() for c in ("na", "nb"))
            sa, sb = (
                np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint8).reshape(x.num_rows, -1).astype(np.int16)
                for c in ("sa", "sb")
            )
            need = -(-num * (na + nb) // (num + den))
            ok = pa.array(np.abs(sa - sb).sum(1) <= na + nb - 2 * need)
            yield pa.RecordBatch.from_arrays([x.column("a").filter(ok), x.column("b").filter(ok)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def few(ids: DataFrame) -> DataFrame:
    """The ids, to be broadcast if a count finds at most ``BROADCAST_IDS``."""
    ids = ids.checkpoint()
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets link, each compared once.

    The suffix filter runs first on the 64 parts that every class carries, then
    on ``PARTS`` parts of the remaining classes, whose texts are read for it;
    only sets of pairs that pass both are moved. Ids and classes are broadcast
    if few, else joined by shuffle.
    """
    pairs = sketched(pairs, classes, num, den).checkpoint()
    nodes = lambda p: p.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes(pairs).join(classes, "node").select(F.col("rep").alias("_id"), F.col("node").alias("want")).checkpoint()
    listed = few(wanted.where("_id is not null"))

    def to_sets(batches):
        for t in slices(batches, "_text"):
            found = [(fingerprint(s) if len(s) else None, s) for s in sets_of(t, n)]
            # rows that share an id may hold other texts
            if "want" in t.rows.schema.names:
                found = [f for f, w in zip(found, t.rows.column("want").to_pylist()) if f[0] == w]
            columns = [pa.array([f for f, _ in found], pa.int64()), pa.array([len(s) for _, s in found], pa.int64())]
            for pack in (lambda s: _wide_sketch(s, PARTS), _packed):
                columns.append(pa.array([pack(s) for _, s in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "sketch", "grams"])

    # a row listed twice gives its set twice, and its links twice: they are made distinct
    shape = "node long, n long, sketch binary, grams binary"
    found = texts.join(listed, "_id").select("_text", "want").mapInArrow(to_sets, shape)
    nameless = wanted.where("_id is null").select(F.col("want").alias("node"))
    if not nameless.isEmpty():  # classes that only rows without an id have: their sets are found by class
        of_class = texts.where("_id is null").select("_text").mapInArrow(to_sets, shape)
        found = found.unionByName(of_class.join(few(nameless), "node", "left_semi").dropDuplicates(["node"]).select(*found.columns))
    found = found.checkpoint()
    pairs = sketched(pairs, found, num, den).distinct().checkpoint()
    sets = found.join(few(nodes(pairs)), "node").select("node", "grams")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")

    def compare(batches):
        for b in batches:
            a_, b_ = b.column("a").to_pylist(), b.column("b").to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                x, y = _unpacked(x.as_buffer()), _unpacked(y.as_buffer())
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                if den * both >= num * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a_[i] for i in keep], pa.int64()), pa.array([b_[i] for i in keep], pa.int64())], ["a", "b"]
            )

    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def jaccard_components(
    docs: DataFrame,
    n: int = 5,
    num: int = 8,
    den: int = 10,
    key: str = "doc_id",
    text: str = "text",
    count_links: bool = True,
    with_class: bool = False,
) -> DataFrame:
    """(key, n_shingles, component_id, n_links) per row; links of a row's class to other texts.

    ``count_links=False`` gives the components alone, without ``n_links``. ``with_class`` adds
    ``class_id``, equal for equal sets, and ``component``, the smallest class of the row's
    component (both NULL without words): what a row is known by where ids repeat or are NULL.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    ranks = spark.sparkContext.broadcast(frequency_ranks(texts, n))

    def describe(batches):
        for t in slices(batches, "_text"):
            sets = sets_of(t, n)
            yield pa.RecordBatch.from_arrays(
                [
                    t.rows.column("_id"),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_wide_sketch(s, 64) for s in sets], pa.binary()),
                ],
                ["_id", "node", "n", "sketch"],
            )

    shape = "_id long, node long, n long, sketch binary"
    rows = texts.select("_id", "_text").mapInArrow(describe, shape).checkpoint()
    classes = rows.where("node is not null").groupBy("node", "n", "sketch").agg(F.min("_id").alias("rep")).checkpoint()
    lists = postings(texts, n, num, den, ranks)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    lists = lists.repartition(width, "token").sortWithinPartitions("token", "centre", "node")
    found = lists.mapInArrow(_candidates(num, den), FOUND).checkpoint()
    pairs = found.where("kind = 0").select("a", "b").distinct().checkpoint()
    links = verified(pairs, texts, classes, n, num, den).checkpoint()
    together = None if count_links else connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    members = found.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("node"), "n", "pos", "sketch")
    if count_links:  # every two members of a long list
        members = members.withColumn("component", F.col("node"))
    else:  # long lists whose members are not all in one component
        members = members.join(together, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_lists = members.groupBy("token").agg(
        F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    open_lists = open_lists.where("x <> y").select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    split = members.join(open_lists, "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    split = split.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    split = split.select(*[F.col(f.split()[0]).cast("long") for f in MEMBER.split(", ")])
    split = split.repartition(width, "token", "one", "two").sortWithinPartitions("token", "one", "two", "n")
    rest = split.mapInArrow(_across(num, den), "a long, b long").distinct()
    rest = rest.join(pairs, ["a", "b"], "left_anti").checkpoint()
    links = links.union(verified(rest, texts, classes, n, num, den)).checkpoint()
    merged = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    known = classes.select("node", "rep").join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = known.checkpoint()
    least = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = known.join(own_exchange(least), "component")
    shown, none = ["component_id"], [F.col("_id").alias("component_id")]
    if count_links:
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        known = known.join(degree, "node", "left")
        shown.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
        none.append(F.lit(0).cast("long").alias("n_links"))
    if with_class:
        shown += [F.col("node").alias("class_id"), "component"]
        none += [F.lit(None).cast("long").alias(c) for c in ("class_id", "component")]
    known = known.select("node", *shown).checkpoint()
    filled = rows.where("node is not null").join(known, "node")
    empty = rows.where("node is null")
    columns = [F.col("_id").alias(key), F.col("n").alias("n_shingles")]
    return filled.select(*columns, *[c for c in known.columns if c != "node"]).union(empty.select(*columns, *none))


def class_of(docs: DataFrame, text: str = "text", n: int = 5) -> DataFrame:
    """``docs`` (for ``whole_rows``) with ``class_id`` of every row's text, NULL without words."""

    def scan(t: Texts) -> dict:
        return {"class_id": [fingerprint(s) if len(s) else None for s in sets_of(t, n)]}

    return annotate_whole(docs, text, [T.StructField("class_id", T.LongType())], scan)
