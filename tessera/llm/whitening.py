"""Whitening of embeddings with MLlib's distributed ``BlockMatrix``.

Vectors become integers, floor(scale * c). The covariance is fitted on the list
of distinct integer vectors. Rows are written in blocks, each the work of one task,
and a row's index is its block's number and its place in it. Centred by the
exact column sums, the fit list's blocks are multiplied, transposed by plain, which
gives the scatter matrix; its eigenvectors are found on the driver (dims x dims),
and a second block multiplication projects the centred rows of the whole table.

Blocks are numbered without gaps from the written table, which holds each block's
task and place, so numbers can't change when a task is repeated; a task's last
block is filled up with zero rows, which change no product. The sums over the
middle dimension are dealt to as many tasks as there are groups of ``GROUP`` blocks.
A block holds at most ``BLOCK_VALUES`` numbers, and its number of rows grows with the
table, since MLlib plans a product on the driver from its list of blocks. Copies
collapse before the fit's shuffle, and rows meet their projection by the block,
so a vector that a third of the rows hold is no hot key.

Rows whose vector is NULL or empty, holds NULL or non-finite entries, or has another
length than most usable vectors (the smaller of equally frequent lengths) get no
result. NULL and repeated ids keep their rows. Components follow falling
eigenvalues; those that vanish against the first (``RANK``) can't be scaled to
unit variance and are left out, so a list of fewer than two distinct vectors gives
no rows. A deviation beyond a long is NULL.
"""

from __future__ import annotations

import decimal
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.rowwise import ROW
from tessera.util import shared_scratch

BLOCK_VALUES = 1 << 20  # 8 MB
BLOCK_ROWS = 1024
MOST_BLOCKS = 1 << 14  # beyond this, blocks grow (up to BLOCK_VALUES)
GROUP = 16
RANK = 1e-12
SMALL = 1 << 62
RESULT = [
    T.StructField("component", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()),
    T.StructField("identity_error", T.DoubleType()),
]


def integers(df: DataFrame, vector: str, scale: float, carry: list[str]) -> DataFrame:
    """``_row`` and ``x``, the integer vector, of every usable row."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(v, lambda c: F.floor(c * scale) + F.lit(0))
    rows = df.where(F.coalesce((F.size(v) > 0) & ~bad, F.lit(False)))
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), x.alias("x"))


def _blocked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in runs of ``size``."""
    held, n = [], 0
    for b in batches:
        while b.num_rows:
            part = b.slice(0, size - n)
            held, n, b = [*held, part], n + part.num_rows, b.slice(part.num_rows)
            if n == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def block_rows(count: int, dims: int) -> int:
    return max(1, min(max(BLOCK_ROWS, -(-count // MOST_BLOCKS)), BLOCK_VALUES // dims))


def write_blocks(rows: DataFrame, size: int, path: str) -> DataFrame:
    """``rows`` (its columns, and ``x``) as a written table of blocks: ``b``, the block's number, ``n`` rows,
    the other columns as lists, ``x`` as the bytes of its integers."""
    others = [c for c in rows.columns if c != "x"]
    schema = T.StructType(
        [T.StructField("n", T.LongType()), T.StructField("x", T.BinaryType())]
        + [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in others]
    )
    types = to_arrow_schema(schema)

    def write(batches):
        for b in _blocked(batches, size):
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8")
            lists = [pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(c)).cast(types.field(c).type) for c in others]
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([x.tobytes()], pa.binary()), *lists], ["n", "x", *others])

    rows.mapInArrow(write, schema).withColumn("m", F.monotonically_increasing_id()).write.parquet(path)
    table = rows.sparkSession.read.parquet(path)
    task = F.shiftright("m", 33)
    before, starts = 0, []
    for r in table.groupBy(task.alias("p")).count().orderBy("p").collect():  # one row a task
        starts.append((r["p"], before))
        before += r["count"]
    side = rows.sparkSession.createDataFrame(starts, "p long, before long")
    place = F.col("m").bitwiseAND(F.lit((1 << 33) - 1))
    table = table.withColumn("p", task).join(F.broadcast(side), "p").withColumn("b", F.col("before") + place)
    return table.drop("p", "m", "before")


def column_sums(blocks: DataFrame, d: int) -> list[int]:
    """Exact sums of every dimension."""

    def add(batches):
        total = np.zeros(d, object)
        for b in batches:
            for x in b.column("x").to_pylist():
                x = np.frombuffer(x, "<i8").reshape(-1, d)
                small = len(x) * int(np.abs(x.astype(np.float64)).max()) < SMALL
                total += x.sum(0).astype(object) if small else x.astype(object).sum(0)
        number = [decimal.Decimal(int(t)) for t in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(number, pa.decimal128(38, 0))], ["j", "s"])

    got = blocks.select("x").mapInArrow(add, "j int, s decimal(38,0)").groupBy("j").agg(F.sum("s").alias("s"))
    return [int(r["s"]) for r in got.orderBy("j").collect()]


def offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: int64 where that holds every value, else Python's integers."""
    most = max(n * max(abs(int(x.max())), abs(int(x.min()))), *map(abs, sums))
    if most < SMALL:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def block_matrix(blocks: DataFrame, size: int, n_blocks: int, n: int, sums: list[int]) -> BlockMatrix:
    """The centred rows as a distributed matrix; ``n`` and ``sums`` are the fit list's."""
    d = len(sums)

    def centred(r):
        gap = offsets(np.frombuffer(r["x"], "<i8").reshape(-1, d), n, sums)
        out = np.zeros((size, d))
        out[: len(gap)] = (gap / n).astype(np.float64)
        return (r["b"], 0), DenseMatrix(size, d, out.ravel(order="F"))

    return BlockMatrix(blocks.select("b", "x").rdd.map(centred), size, d, size * n_blocks, d)


def transposed_product(a: BlockMatrix) -> np.ndarray:
    """a^T a on the driver (columns x columns); the middle dimension is dealt to many tasks."""
    groups = max(1, -(-a.numRowBlocks // GROUP))
    got = a.transpose()._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(got, a.colsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(dims x components matrix of scaled eigenvectors, their eigenvalues), falling."""
    value, vector = np.linalg.eigh((covariance + covariance.T) / 2)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    keep = (value > 0) & (value > RANK * value[0])
    value, vector = value[keep], vector[:, keep]
    return vector / np.sqrt(value), value


def project(spark: SparkSession, a: BlockMatrix, w: np.ndarray) -> BlockMatrix:
    block = DenseMatrix(*w.shape, w.ravel(order="F").tolist())
    return a.multiply(BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), w.shape[0], w.shape[1]))


def whiten(
    df: DataFrame, vector: str = "embedding", scale: float = 256.0, components: int = 4, carry: list[str] | None = None
) -> DataFrame:
    """``_row``, component, n, deviation, whitened, explained and identity_error: one row for every
    usable vector and component."""
    spark = df.sparkSession
    carry = [c for c in df.columns if c != vector] if carry is None else carry
    rows = integers(df, vector, scale, carry)
    result = T.StructType([rows.schema[ROW], *RESULT])
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if lengths is None:
        return spark.createDataFrame([], result)
    d, count = lengths["d"], lengths["count"]
    rows, size, home = rows.where(F.size("x") == d), block_rows(count, d), shared_scratch(spark, "whitening")
    fit = write_blocks(rows.select("x").distinct(), size, os.path.join(home, "fit"))
    n, fit_blocks = fit.agg(F.sum("n"), F.count("*")).first()
    if n < 2:
        return spark.createDataFrame([], result)
    sums = column_sums(fit, d)
    a = block_matrix(fit, size, fit_blocks, n, sums).persist(StorageLevel.MEMORY_AND_DISK)  # read three times
    covariance = transposed_product(a) / n
    w, value = whitening_matrix(covariance, components)
    explained, k = value / np.trace(covariance), len(value)
    error = float(np.abs(transposed_product(project(spark, a, w)) / n - np.eye(k)).max()) if k else 0.0
    a._java_matrix_wrapper._java_model.blocks().unpersist(False)
    if not k:
        return spark.createDataFrame([], result)
    table = write_blocks(rows, size, os.path.join(home, "rows"))
    projected = project(spark, block_matrix(table, size, table.count(), n, sums), w)
    found = projected.blocks.map(lambda block: (block[0][0], np.asarray(block[1].toArray(), "<f8").tobytes()))
    types = to_arrow_schema(result)

    def unpack(batches):
        for b in batches:
            for at in range(b.num_rows):
                x = np.frombuffer(b.column("x")[at].as_py(), "<i8").reshape(-1, d)
                gap = offsets(x, n, sums)
                if gap.dtype != object and float(np.abs(gap.astype(np.float64)).max()) ** 2 * d >= SMALL:
                    gap = gap.astype(object)
                far = [v if v < 1 << 63 else None for v in map(int, (gap * gap).sum(1))]
                white = np.frombuffer(b.column("w")[at].as_py(), "<f8").reshape(size, k)[: len(x)]
                row = b.column(ROW).slice(at, 1).flatten().take(pa.array(np.repeat(np.arange(len(x)), k)))
                values = [np.tile(np.arange(1, k + 1), len(x)), np.full(len(x) * k, n), [v for v in far for _ in range(k)]]
                values += [white.ravel(), np.tile(explained, len(x)), np.full(len(x) * k, error)]
                columns = [pa.array(v, f.type) for v, f in zip(values, list(types)[1:])]
                yield pa.RecordBatch.from_arrays([row, *columns], types.names)

    return table.join(spark.createDataFrame(found, "b long, w binary"), "b").mapInArrow(unpack, result)
