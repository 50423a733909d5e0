"""Parquet file-set scans (SRC-5 … SRC-10, SET-2).

* ``read_files`` — many paths, or folders of files, as one table. Files are
  grouped by physical schema, each group is one scan cast to the declared
  schema, and the groups are unioned by name. So a column that only some files
  have keeps its values, and a column whose type drifts between files reads.
  Footers of files on a mounted path are read in one distributed pass. Any
  other store is reached as Spark reaches it, through Hadoop: Spark's own
  distributed schema merge answers for file sets whose types agree; only where
  they don't are the footers read one by one, by threads of the driver.
* ``newer_than`` — files whose footer says that no row of a timestamp column lies
  after a bound are left out: they are not scanned.
* ``read_changed_files`` — only files modified after a point in time, using
  the reader's ``modifiedAfter`` filter (applied while listing, so old files
  are never opened).
* ``target_exists`` / ``read_parquet_or_none`` — the first-run probe.
* ``empty_frame`` — a typed empty table, so "no input" flows through the same
  plan instead of a special exit.

Building a frame takes the same number of Spark jobs however many files there
are: one listing, one footer pass or schema merge, and one parallel listing per
schema group.
The driver holds the file names, as any Spark file scan does.
"""

from __future__ import annotations

import datetime as dt
import warnings
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Error conditions that mean "there is no table here yet".
MISSING_TABLE_CONDITIONS = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names and order, tolerant casts,
    NULL for a missing column."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(cols)


def _reader(spark: SparkSession, recursive: bool, modified_after: str | None = None):
    """``recursive`` reads every file below a directory (a drop folder with
    sub-folders per day), without partition discovery."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader


def read_parquet_or_none(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame | None:
    try:
        return _reader(spark, recursive).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in MISSING_TABLE_CONDITIONS:
            return None
        raise


FOOTERS = "path string, layout string, ok boolean, high long"
#: threads that read footers through the Hadoop file system, and files handed to them at a time
FOOTER_THREADS, FOOTER_CHUNK = 16, 2000
EPOCH = dt.datetime(1970, 1, 1)


def micros(t: dt.datetime) -> int:
    """Microseconds since 1970 of a zone-less time, or of the UTC time of an instant."""
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (t - EPOCH) // dt.timedelta(microseconds=1)


def _read_footers(column: str | None):
    """(path, physical schema text, readable, latest value of ``column``) per file, on the executors.

    The latest value is NULL where the footer doesn't tell it."""

    def latest(meta) -> int | None:
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        if column not in names:
            return None
        found = []
        for g in range(meta.num_row_groups):
            chunk = meta.row_group(g).column(names.index(column))
            stats = chunk.statistics
            if stats is not None and stats.has_null_count and stats.null_count == chunk.num_values:
                continue  # no row of the group has a time
            if stats is None or not stats.has_min_max or not isinstance(stats.max, dt.datetime):
                return None
            found.append(micros(stats.max))
        return max(found, default=None)

    def read(batches):
        from urllib.parse import quote

        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import ArrowInvalid
        from pyarrow.fs import FileSystem

        for paths in batches:
            out = []
            for path in paths["path"]:
                fs, name = FileSystem.from_uri(quote(path, safe="/:"))
                try:
                    meta = pq.read_metadata(name, filesystem=fs)
                    layout = "\n".join(f"{f.name}: {f.type}" for f in meta.schema.to_arrow_schema())
                    out.append((path, layout, True, latest(meta)))
                except ArrowInvalid:  # not a Parquet file
                    out.append((path, "", False, None))
            got = pd.DataFrame(out, columns=["path", "layout", "ok", "high"])
            yield got.astype({"high": "Int64"})

    return read


def file_layouts(spark: SparkSession, paths: list[str], column: str | None = None) -> DataFrame:
    """The physical schema of every file, read in one distributed pass."""
    width = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    names = spark.createDataFrame([(p,) for p in paths], "path string").repartition(width)
    return names.mapInPandas(_read_footers(column), FOOTERS)


def _hadoop_footer(spark: SparkSession, path: str, column: str | None) -> tuple[str, str, bool, int | None]:
    """What ``_read_footers`` tells of a file, read through the Hadoop file system."""
    jvm = spark._jvm
    parquet = jvm.org.apache.parquet
    converter = parquet.format.converter.ParquetMetadataConverter
    at = jvm.org.apache.hadoop.fs.Path(path)
    part = converter.SKIP_ROW_GROUPS if column is None else converter.NO_FILTER
    try:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        meta = parquet.hadoop.ParquetFileReader.readFooter(conf, at, part)
    except Py4JJavaError as e:
        if "not a Parquet file" in str(e.java_exception):
            return path, "", False, None
        raise
    layout = meta.getFileMetaData().getSchema().toString().partition("{")[2]
    if column is None:
        return path, layout, True, None
    found = []
    for block in meta.getBlocks():
        chunk = next((c for c in block.getColumns() if c.getPath().toDotString() == column), None)
        stats = None if chunk is None else chunk.getStatistics()
        if stats is not None and stats.getNumNulls() == chunk.getValueCount():
            continue
        kind = "" if chunk is None else str(chunk.getPrimitiveType().getLogicalTypeAnnotation())
        if stats is None or not stats.hasNonNullValue() or not kind.startswith("TIMESTAMP(MICROS"):
            return path, layout, True, None
        found.append(stats.genericGetMax())
    return path, layout, True, max(found, default=None)


def _mounted(path: str) -> bool:
    """Whether executors open the file by its name (a shared mount, or local mode)."""
    return path.startswith(("file:", "/"))


def _footers(spark: SparkSession, paths: list[str], column: str | None) -> list[tuple]:
    """(path, layout, readable, latest value of ``column`` or None) of every file."""
    if all(map(_mounted, paths)):
        return [tuple(r) for r in file_layouts(spark, paths, column).collect()]
    out = []
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        for k in range(0, len(paths), FOOTER_CHUNK):
            out += pool.map(lambda p: _hadoop_footer(spark, p, column), paths[k : k + FOOTER_CHUNK])
    return out


def _merged_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The schema of all files by Spark's distributed merge (one job); None where types disagree
    or a file is not Parquet."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError):  # told file by file in what follows
        return None


class ForeignFiles(ValueError):
    """The input holds files that are not Parquet."""


def _groups(
    spark: SparkSession, paths: list[str], foreign: str, newer_than: tuple[str, dt.datetime] | None = None
) -> list[tuple[list[str], T.StructType | None]]:
    """The paths grouped by physical schema, each group with its schema where that is known already;
    ``foreign`` files are refused or reported, files without a row after ``newer_than`` left out."""
    if newer_than is None and not all(map(_mounted, paths)):
        with _parallel_listing(spark):
            schema = _merged_schema(spark, paths)
        if schema is not None:
            return [(paths, schema)]
    column, bound = newer_than or (None, EPOCH)
    found: dict[str, list[str]] = {}
    other = []
    for path, layout, ok, high in _footers(spark, paths, column):
        if not ok:
            other.append(path)
        elif high is None or high > micros(bound):
            found.setdefault(layout, []).append(path)
    if other:
        text = f"{len(other)} files are not Parquet: {', '.join(sorted(other)[:10])}"
        if foreign != "skip":
            raise ForeignFiles(text)
        warnings.warn(text, stacklevel=3)
    return [(sorted(found[k]), None) for k in sorted(found)]


@contextmanager
def _parallel_listing(spark: SparkSession):
    """List explicit paths on the executors, whatever their number."""
    key = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "0")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def target_exists(spark: SparkSession, path: str) -> bool:
    """SRC-7: a missing path or an empty directory both mean first run."""
    return read_parquet_or_none(spark, path) is not None


def read_files(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType | None = None,
    modified_after: str | None = None,
    recursive: bool = True,
    group_by_schema: bool = True,
    foreign: str = "error",
    newer_than: tuple[str, dt.datetime] | None = None,
) -> DataFrame:
    """All files below ``paths`` as one table conforming to ``schema`` (SRC-5, SET-2).

    ``schema=None`` takes the columns of all files (the first type found for a
    column). No files give an empty table of ``schema`` (SRC-10). Files that are
    not Parquet fail the read (``foreign="skip"`` leaves them out with a
    warning that names them). ``group_by_schema=False`` scans everything at once
    with the declared schema — for file sets known to share their types.
    ``newer_than`` (a timestamp column and a bound) leaves out files whose footer
    says that all their rows are at or below the bound, or have no time."""
    if paths and not group_by_schema and schema is not None:
        return _reader(spark, recursive, modified_after).schema(schema).parquet(*paths)
    files = changed_file_paths(spark, paths, modified_after, recursive) if paths else []
    if schema is None and not files:
        raise ValueError(f"no readable files in {paths} and no declared schema")
    return read_listed(spark, files, schema, foreign, newer_than)


def read_listed(
    spark: SparkSession,
    files: list[str],
    schema: T.StructType | None = None,
    foreign: str = "error",
    newer_than: tuple[str, dt.datetime] | None = None,
) -> DataFrame:
    """``read_files`` of files that have been listed already."""
    frames = []
    with _parallel_listing(spark):
        for group, known in _groups(spark, files, foreign, newer_than) if files else []:
            reader = spark.read if known is None else spark.read.schema(known)
            frames.append(reader.parquet(*group))
    if schema is None:
        if not frames:
            raise ValueError(f"no readable files and no declared schema")
        fields: dict[str, T.StructField] = {}
        for f in (f for frame in frames for f in frame.schema.fields):
            fields.setdefault(f.name, f)
        schema = T.StructType(list(fields.values()))
    if not frames:
        return empty_frame(spark, schema)
    left_out = sorted({c for frame in frames for c in frame.columns} - set(schema.names))
    if left_out:
        warnings.warn(f"columns that the declared schema lacks are left out: {', '.join(left_out)}", stacklevel=2)
    out = conform(frames[0], schema)
    for other in frames[1:]:
        out = out.unionByName(conform(other, schema))
    return out


def since_hours_ago(hours: float, now: dt.datetime | None = None, time_zone: str = "UTC") -> str:
    """ISO text of now − ``hours`` as wall-clock time in ``time_zone`` — pass
    the session time zone, in which the reader interprets ``modifiedAfter``."""
    from zoneinfo import ZoneInfo

    now = now or dt.datetime.now(dt.timezone.utc)
    return (now - dt.timedelta(hours=hours)).astimezone(ZoneInfo(time_zone)).strftime("%Y-%m-%dT%H:%M:%S")


def changed_file_paths(
    spark: SparkSession, path: str | list[str], since: str | None = None, recursive: bool = True
) -> list[str]:
    """Paths of the files under ``path`` modified strictly after ``since`` (all without it).

    Listed by a scan that reads no data column (only the file-path metadata
    column of the binary reader, which opens no file), so files of any kind can
    be listed together. The list is file metadata, one entry per file; missing
    paths hold no files."""
    found: list[str] = []
    for p in [path] if isinstance(path, str) else path:
        try:
            listing = _reader(spark, recursive, since).format("binaryFile").load(p)
        except AnalysisException as e:
            if e.getCondition() in MISSING_TABLE_CONDITIONS:
                continue
            raise
        found += map(unquote, listing.inputFiles())
    return sorted(set(found))


def read_changed_files(
    spark: SparkSession,
    path: str,
    since: str,
    schema: T.StructType | None = None,
    recursive: bool = True,
    group_by_schema: bool = True,
    foreign: str = "error",
    newer_than: tuple[str, dt.datetime] | None = None,
) -> DataFrame:
    """Files under ``path`` modified strictly after ``since`` (SRC-9).

    A declared schema keeps the result typed when nothing matches; without one
    the columns come from all files under ``path``. The changed files are
    grouped by physical schema as ``read_files`` does; ``group_by_schema=False``
    is a single scan for file sets known to share their types."""
    if schema is None:
        schema = read_files(spark, [path], recursive=recursive, foreign=foreign).schema
    return read_files(spark, [path], schema, since, recursive, group_by_schema, foreign, newer_than)
