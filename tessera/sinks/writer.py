"""Writers and result helpers (SNK-1 … SNK-8).

Output file count is left to adaptive execution (and optionally capped by
``max_records_per_file``); a single output file is opt-in, because
``coalesce(1)`` runs the whole final stage as one task.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write(
    df: DataFrame | None,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
    max_records_per_file: int | None = None,
    partition_by: list[str] | None = None,
    target_file_bytes: int | None = None,
    bytes_per_row: float | None = None,
) -> bool:
    """Write ``df`` (SNK-1). ``None`` is a no-op that returns False (SNK-3).

    ``mode="errorifexists"`` is the create-only write (SNK-4). With
    ``target_file_bytes`` rows are dealt anew so that no task writes much more than
    that, by ``partition_by`` where given: adaptive execution splits a value that
    holds more and joins small ones. ``bytes_per_row`` (measured on a written set
    of such rows: ``bytes_per_row_of``) also caps the rows of each file."""
    if df is None:
        return False
    if single_file:
        df = df.coalesce(1)
    elif target_file_bytes:
        with _sized(df.sparkSession, target_file_bytes):
            rows = math.ceil(target_file_bytes / bytes_per_row) if bytes_per_row else max_records_per_file
            return write(df.hint("rebalance", *(partition_by or [])), path, format, mode, False, rows, partition_by)
    w = df.write.mode(mode).format(format)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return True


@contextmanager
def _sized(spark: SparkSession, target_file_bytes: int):
    """Adaptive execution splits and joins partitions to that size while the block runs."""
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], str(target_file_bytes))
    spark.conf.set(keys[1], str(max(1, target_file_bytes // 4)))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def bytes_per_row_of(written: DataFrame) -> float | None:
    """Stored bytes a row of a table of files, from the files' sizes and counts (no column is read)."""
    files = written.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    total = files.agg(F.sum("file_size").alias("b"), F.sum("n").alias("n")).first()
    return total["b"] / total["n"] if total["n"] else None


def write_new(df: DataFrame, path: str, format: str = "parquet", **kw) -> bool:
    """Create-only write: fails if ``path`` already exists (SNK-4)."""
    return write(df, path, format=format, mode="errorifexists", **kw)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows, in no particular order (SNK-5, LIM-1)."""
    return df.limit(n)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition of ``df`` (SNK-8): the partition count is the
    number of rows, and the spread of ``rows`` shows skew."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs ``df``
    next (SNK-7): the count costs no extra pass over the data."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
