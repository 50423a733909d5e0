"""Centroid clustering over a vector-approximation file.

Vectors are scaled to integers, floor(scale * x). The index (``approximate``)
stores every vector twice in one table: as cells of ``BITS`` bits a dimension, two
dimensions to a byte, and whole. A dimension's cells are cut at the quantiles of
a normal distribution with its mean and deviation, measured over all rows, so
that each holds about as many vectors; they change the speed only.

For every round's centroids a lookup table gives, for each pair of dimensions and
each of the 256 pairs of cells, the least and the greatest squared distance to
each centroid. The sums of a row's entries are its distance intervals. Where one
interval ends before the others begin the nearest centroid is known; only rows
whose intervals overlap have their whole vector read and compared exactly (ties:
the smaller number).

A centroid's sums change only by the vectors that move: from the second round on,
a round adds up the vectors whose cluster under the new centroids differs from
the one under the old, so the whole vector is read for rows that overlap or move.
All sums and distances are exact integers.

Every pass is a narrow ``mapInArrow`` over the index; what is shuffled is one
row per task, cluster and dimension, and the driver holds centroids only.

Vectors that are NULL, have another number of components than ``dims``, or hold a
NULL or non-finite component get no row. Rows without an id, or with the same id,
are clustered like others; a NULL id never starts a centroid, equal ids come in
the order of their vectors. Fewer vectors than ``k`` start fewer centroids; none give
an empty result. A distance or inertia beyond a long is NULL.
"""

from __future__ import annotations

import decimal
import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.rowwise import ROW
from tessera.util import shared_scratch

BITS = 4
CELLS = 1 << BITS
SLACK = 1e-9  # keeps intervals whole where sums exceed a double's integers
EXACT = 1 << 27  # components below this size: int64 holds 64 squared differences and their sums
STATS = "dim int, n long, total double, squares double, low double, high double"
SUMS = T.StructType(
    [
        T.StructField("cluster", T.IntegerType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("total", T.DecimalType(38, 0)),
    ]
)
COUNT_DIM = -1  # the dimension that carries a cluster's count


@dataclass
class Index:
    """A written approximation file and what its readers need to know."""

    table: DataFrame  # _row, cells, x
    edges: np.ndarray  # (dims, CELLS + 1): cell j of a dimension holds edges[j] <= x < edges[j + 1]
    width: str  # numpy type of the stored whole vectors
    dims: int


def _vectors(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            v = b.column("v")
            yield b, v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), dims)


def _scaled(v: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(v * scale)


def usable(df: DataFrame, vector: str, dims: int) -> Column:
    """Whether a row's vector can be clustered."""
    v = F.col(f"`{vector}`")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce((F.size(v) == dims) & ~bad, F.lit(False))


def approximate(df: DataFrame, vector: str = "embedding", dims: int = 64, scale: float = 64.0, carry: list[str] | None = None) -> Index:
    """Write the approximation file of ``df`` into the shared folder."""
    spark = df.sparkSession
    carry = [c for c in df.columns if c != vector] if carry is None else carry
    src = df.where(usable(df, vector, dims)).select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    edges, width = _cells(src, dims, scale)

    def write(batches):
        for b, v in _vectors(batches, dims):
            x = _scaled(v, scale)
            cells = np.zeros(x.shape, np.uint8)
            for d in range(dims):
                cells[:, d] = np.clip(np.searchsorted(edges[d], x[:, d], "right") - 1, 0, CELLS - 1)
            if dims % 2:
                cells = np.pad(cells, ((0, 0), (0, 1)))
            packed = cells[:, 0::2] | (cells[:, 1::2] << BITS)
            whole = x.astype(width)
            yield pa.RecordBatch.from_arrays(
                [b.column(ROW), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array([r.tobytes() for r in whole], pa.binary())],
                [ROW, "cells", "x"],
            )

    schema = T.StructType([src.schema[ROW], T.StructField("cells", T.BinaryType()), T.StructField("x", T.BinaryType())])
    path = os.path.join(shared_scratch(spark, "va"), "index")
    src.mapInArrow(write, schema).write.parquet(path)
    return Index(spark.read.parquet(path), edges, width, dims)


def _cells(src: DataFrame, dims: int, scale: float) -> tuple[np.ndarray, str]:
    """Cell edges of every dimension from one pass, and the narrowest type for whole vectors."""

    def measure(batches):
        n, total, squares = 0, np.zeros(dims), np.zeros(dims)
        low, high = np.full(dims, np.inf), np.full(dims, -np.inf)
        for _, v in _vectors(batches, dims):
            x = _scaled(v, scale)
            n += len(x)
            with np.errstate(over="ignore"):
                total, squares = total + x.sum(0), squares + (x * x).sum(0)
            low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), *map(pa.array, (total, squares, low, high))],
                ["dim", "n", "total", "squares", "low", "high"],
            )

    got = src.mapInArrow(measure, STATS).groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    edges = np.zeros((dims, CELLS + 1))
    edges[:, -1] = 1
    cuts = np.array([NormalDist().inv_cdf(j / CELLS) for j in range(1, CELLS)])
    most = 0.0
    for r in got.collect():  # one row a dimension
        mean = r["total"] / r["n"]
        spread = np.sqrt(max(r["squares"] / r["n"] - mean * mean, 0.0))
        if not np.isfinite(mean + spread):
            mean, spread = r["low"] / 2 + r["high"] / 2, r["high"] / 4 - r["low"] / 4
        inner = np.clip(np.ceil(mean + spread * cuts), r["low"], r["high"])
        edges[r["dim"]] = [r["low"], *inner, np.nextafter(r["high"] + 1, np.inf)]
        most = max(most, abs(r["low"]), abs(r["high"]))
    return edges, "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def lookup(edges: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(pairs of dimensions, 256, 2k): least, then greatest squared distances to each centroid."""
    dims, k = len(edges), len(centroids)
    low, high = edges[:, :-1, None], np.maximum(edges[:, 1:, None] - 1, edges[:, :-1, None])
    c = centroids.astype(np.float64).T[:, None, :]
    with np.errstate(over="ignore"):
        near = np.maximum(np.maximum(low - c, c - high), 0.0) ** 2
        far = np.maximum(np.abs(low - c), np.abs(high - c)) ** 2
    # The last edge is open by a rounding step; far must cover it.
    one = np.concatenate([near * (1 - SLACK), far * (1 + SLACK)], axis=2)
    if dims % 2:
        one = np.concatenate([one, np.zeros((1, CELLS, 2 * k))])
    return (one[1::2, :, None, :] + one[0::2, None, :, :]).reshape((dims + 1) // 2, 256, 2 * k)


def wide(rows: list[bytes], width: str, dims: int) -> np.ndarray:
    """Whole vectors as exact integers (Python's where an int64 could overflow)."""
    x = np.frombuffer(b"".join(rows), width).reshape(len(rows), dims)
    if width == "<f8" or (x.size and np.abs(x.astype(np.int64)).max() >= EXACT):
        return np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)
    return x.astype(np.int64)


def _fit(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exactly comparable vectors and centroids: int64 where both are small."""
    if x.dtype == object or np.abs(centroids.astype(object)).max() >= EXACT:
        return x.astype(object), centroids.astype(object)
    return x, centroids.astype(np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column a centroid."""
    x, centroids = _fit(x, centroids)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


class Nearest:
    """Nearest centroid of a batch's rows: by intervals, exactly where they overlap."""

    def __init__(self, index_edges: np.ndarray, centroids: np.ndarray, width: str):
        self.centroids, self.width, self.dims = centroids, width, len(index_edges)
        self.table = lookup(index_edges, centroids)

    def __call__(self, cells: np.ndarray, fetch: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(cluster of every row, the rows whose whole vector was fetched)."""
        k = len(self.centroids)
        bounds = np.zeros((len(cells), 2 * k))
        for p in range(cells.shape[1]):
            bounds += self.table[p][cells[:, p]]
        near, far = bounds[:, :k], bounds[:, k:]
        best = far.argmin(1)
        reach = near <= far[np.arange(len(far)), best][:, None]
        # Where bounds aren't finite, no interval ends before another.
        reach |= ~np.isfinite(far).all(1)[:, None]
        open_rows = np.flatnonzero(reach.sum(1) > 1)
        if len(open_rows):
            best[open_rows] = squared(fetch(open_rows), self.centroids).argmin(1)
        return best, open_rows


def _columns(b: pa.RecordBatch, pairs: int) -> tuple[np.ndarray, list]:
    cells = np.frombuffer(b"".join(b.column("cells").to_pylist()), np.uint8).reshape(b.num_rows, pairs)
    return cells, b.column("x")


def _fetcher(column, width: str, dims: int) -> Callable[[np.ndarray], np.ndarray]:
    return lambda rows: wide(column.take(pa.array(rows)).to_pylist(), width, dims)


def moved_sums(index: Index, centroids: np.ndarray, before: np.ndarray | None) -> dict[tuple[int, int], int]:
    """What each cluster gains (count and sums by dimension) since the centroids ``before``; all of it without them."""
    edges, width, dims = index.edges, index.width, index.dims
    pairs, k = (dims + 1) // 2, len(centroids)

    def add(batches):
        now = Nearest(edges, centroids, width)
        then = None if before is None else Nearest(edges, before, width)
        total = np.zeros((k, dims + 1), object)
        for b in batches:
            if not b.num_rows:
                continue
            cells, column = _columns(b, pairs)
            fetch = _fetcher(column, width, dims)
            new, _ = now(cells, fetch)
            if then is None:
                rows, old = np.arange(len(new)), None
            else:
                old, _ = then(cells, fetch)
                rows = np.flatnonzero(new != old)
                if not len(rows):
                    continue
                old = old[rows]
            x = fetch(rows)
            for sign, cluster in ((1, new[rows]), (-1, old)):
                for c in np.unique(cluster) if cluster is not None else ():
                    mine = x[cluster == c]
                    total[c, :dims] += sign * mine.sum(0).astype(object)
                    total[c, dims] += sign * len(mine)
        c, d = np.nonzero(total)
        number = [decimal.Decimal(int(v)) for v in total[c, d]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()), pa.array(np.where(d == dims, COUNT_DIM, d), pa.int32()), pa.array(number, pa.decimal128(38, 0))],
            SUMS.names,
        )

    rows = index.table.select("cells", "x").mapInArrow(add, SUMS).groupBy("cluster", "dim").agg(F.sum("total").alias("total"))
    return {(r["cluster"], r["dim"]): int(r["total"]) for r in rows.collect()}  # at most k * (dims + 1) rows


def start_centroids(index: Index, key: Column, k: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``1:<id>``, in that order."""
    mark = F.sha2(F.concat(F.lit("1:"), key.cast("string")), 256)
    rows = index.table.select(mark.alias("h"), "x").where("h is not null").orderBy("h", "x").limit(k).collect()
    return wide([bytes(r["x"]) for r in rows], index.width, index.dims).astype(object)


def centroid_sha256(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()


FINAL = [T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]


def clusters(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: float = 64.0, k: int = 16, rounds: int = 3,
    carry: list[str] | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """(``_row``, cluster and squared distance of every usable vector; the final centroids).

    ``rounds`` times every vector goes to its nearest centroid, which then becomes the
    floor of its vectors' mean (an empty one stays); a last assignment follows."""
    spark: SparkSession = df.sparkSession
    carry = [c for c in df.columns if c != vector] if carry is None else carry
    index = approximate(df, vector, dims, scale, carry)
    now, before = start_centroids(index, F.col(ROW)[key], k), None
    result = T.StructType([index.table.schema[ROW], *FINAL])
    if not len(now):
        return spark.createDataFrame([], result), now
    held: dict[tuple[int, int], int] = {}
    for _ in range(rounds):
        for at, gain in moved_sums(index, now, before).items():
            held[at] = held.get(at, 0) + gain
        before, now = now, now.copy()
        for c in range(len(now)):
            if n := held.get((c, COUNT_DIM), 0):
                now[c] = [held.get((c, d), 0) // n for d in range(dims)]
    return index.table.mapInArrow(_last(index, now), result), now


def _last(index: Index, centroids: np.ndarray) -> Callable:
    edges, width, dims = index.edges, index.width, index.dims

    def assign(batches):
        nearest = Nearest(edges, centroids, width)
        for b in batches:
            if not b.num_rows:
                continue
            cells, column = _columns(b, (dims + 1) // 2)
            fetch = _fetcher(column, width, dims)
            cluster, _ = nearest(cells, fetch)
            x, c = _fit(fetch(np.arange(b.num_rows)), centroids)
            far = ((x - c[cluster]) ** 2).sum(1)
            number = [v if v < 1 << 63 else None for v in map(int, far)]
            yield pa.RecordBatch.from_arrays(
                [b.column(ROW), pa.array(cluster, pa.int32()), pa.array(number, pa.int64())], [ROW, "cluster", "distance"]
            )

    return assign


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with each cluster's inertia, the whole inertia and the centroid's digest.

    ``assigned`` is read twice; give it as a written table."""
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # at most k rows
    inertia = {r["cluster"]: None if r["s"] is None else int(r["s"]) for r in sums}
    whole = sum(v for v in inertia.values() if v is not None)
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    rows = [(c, fits(v), fits(whole), centroid_sha256(centroids[c])) for c, v in inertia.items()]
    side = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(side), "cluster")
