"""Versioned publish of a table (the load's sink).

A table root holds the directories that versions were written to and a commit
log ``_versions/`` with one JSON file per version. An entry lists the parts the
version consists of: one directory, or for a bucketed table one directory per
bucket of the key. A run writes its parts to a directory of its own, then its log
entry whole under a temporary name, and renames that to the next version's, which
is refused if another writer has published it; readers take the highest version.
So a run that ends at any point leaves the last good version readable and the next
version free, a run never overwrites the files it reads, and of two runs that
started from the same version only one is published.

The rename happens under a lock file that is held for a moment; a lock older than
``LEASE`` seconds was left by a run that ended, and is removed. An entry that is
empty or cut off counts as absent. Row counts and watermarks are read from the
written files, so repeated task attempts can't be counted twice.

A bucketed publish may carry only the buckets it changed: the other buckets'
parts are taken over from the version before, unread and unwritten. The log also
records the bytes a written row takes, from which a load sees when a table has
outgrown its buckets.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_DIR = "_versions"
STAGING_DIR = "_staging"
BUCKET = "_bucket"
WHOLE = -1  # the bucket number of a part that is the whole table
PART = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("committed_at", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("listed_at", T.StringType()),
        T.StructField("buckets", T.LongType()),
        T.StructField("parts", T.ArrayType(PART)),
        T.StructField("staged", T.StringType()),
        T.StructField("row_bytes", T.DoubleType()),
    ]
)
#: seconds after which a commit's lock has been left by a run that ended
LEASE = 60.0
#: hours after which directories that no version names have been left by runs that ended
ORPHAN_HOURS = 7 * 24.0


class ConcurrentPublish(RuntimeError):
    """Another run has published the version this one was about to."""


@dataclass
class Live:
    """The live version: number, parts, and what its run recorded."""

    version: int
    parts: list
    buckets: int
    watermark: str | None
    n_bytes: int | None = None  # about: rows x bytes of a row as last written


def staging_path(root: str, run: str) -> str:
    """Where the run of that name stages its inputs (ignored by table readers)."""
    return os.path.join(root, STAGING_DIR, run)


def staged_path(spark: SparkSession, root: str, version: int) -> str:
    """The staged inputs of a committed version."""
    row = version_log(spark, root).where(F.col("version") == version).first()
    if row is None:
        raise ValueError(f"{root} has no version {version}")
    return staging_path(root, row["staged"] or f"version={version}")


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key (NULL keys share one)."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")


def version_log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        log = spark.read.schema(LOG_SCHEMA).json(os.path.join(root, LOG_DIR))
        return log.where("version is not null and parts is not null")  # else cut off
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def live(spark: SparkSession, root: str) -> Live | None:
    """The highest committed version, or None for a table never published."""
    log = version_log(spark, root)
    row = None if log is None else log.orderBy(F.col("version").desc()).first()
    if row is None:
        return None
    n_bytes = None if row["row_bytes"] is None else int(row["rows"] * row["row_bytes"])
    return Live(int(row["version"]), row["parts"], int(row["buckets"] or 0), row["watermark"], n_bytes)


def current_version(spark: SparkSession, root: str) -> int | None:
    """Highest committed version, or None for a table never published."""
    now = live(spark, root)
    return None if now is None else now.version


def version_paths(spark: SparkSession, root: str, version: int) -> list[str]:
    """The directories a version consists of."""
    row = version_log(spark, root).where(F.col("version") == version).first()
    return [os.path.join(root, p["path"]) for p in row["parts"]]


def read_parts(
    spark: SparkSession, root: str, parts: list, schema: T.StructType | None = None, format: str = "parquet"
) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(format).load([os.path.join(root, p["path"]) for p in parts])


def read_current(
    spark: SparkSession, root: str, schema: T.StructType | None = None, format: str = "parquet"
) -> DataFrame | None:
    """The live version of the table, or None before the first publish."""
    now = live(spark, root)
    return None if now is None else read_parts(spark, root, now.parts, schema, format)


def published_watermark(spark: SparkSession, root: str) -> str | None:
    """The live version's recorded high-watermark (ISO text), if one was
    recorded at publish time; it spares a scan of the table's timestamp
    column on the next run."""
    now = live(spark, root)
    return None if now is None else now.watermark


def source_published(spark: SparkSession, root: str, source: str) -> bool:
    """Whether the input named ``source`` (a stream's id and micro-batch) has been published."""
    log = version_log(spark, root)
    return log is not None and not log.filter(F.col("source") == source).isEmpty()


def last_listing(spark: SparkSession, root: str) -> str | None:
    """When the source files of the latest published version were listed."""
    log = version_log(spark, root)
    return None if log is None else log.agg(F.max("listed_at").alias("t")).first()["t"]


def file_system(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored_bytes(spark: SparkSession, location: str) -> int:
    """Bytes of all files under a path (0 where there is none)."""
    path, fs = file_system(spark, location)
    return int(fs.getContentSummary(path).getLength()) if fs.exists(path) else 0


def delete_path(spark: SparkSession, location: str) -> bool:
    path, fs = file_system(spark, location)
    return bool(fs.exists(path) and fs.delete(path, True))


def _put(fs, path, text: str) -> None:
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _whole(spark: SparkSession, fs, path) -> bool:
    """Whether a log entry is there and was written to its end."""
    if not fs.exists(path):
        return False
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)["parts"] is not None
    except (ValueError, KeyError, TypeError):
        return False


def _take_lock(fs, lock, probe, taken) -> bool:
    """Create the lock file; False if ``taken`` says meanwhile that there is nothing left to commit.

    ``probe`` is a file that is rewritten to learn the store's time."""
    while not taken():
        try:
            fs.create(lock, False).close()
            return True
        except Exception as e:  # a Java FileAlreadyExistsException, by way of the gateway
            try:
                since = fs.getFileStatus(lock).getModificationTime()
            except Exception:  # released in between
                if fs.exists(lock):
                    raise e from None
                continue
            _put(fs, probe, "")
            if fs.getFileStatus(probe).getModificationTime() - since > 1000 * LEASE:
                fs.delete(lock, False)
            else:
                time.sleep(0.1)
    return False


def _commit(spark: SparkSession, root: str, entry: dict) -> None:
    """Publish the version's log entry, unless another run has: write, lock, rename.

    (The lock is a file created if absent, which is atomic on HDFS and local file
    systems; on an object store it is as strong as that store's Hadoop connector.)"""
    name = f"{entry['version']:010d}"
    log, run = os.path.join(root, LOG_DIR), new_run()
    final, fs = file_system(spark, os.path.join(log, f"{name}.json"))
    new, probe, lock = (file_system(spark, os.path.join(log, f))[0] for f in (f".{run}.json", f".{run}.probe", f".{name}.lock"))
    refused = ConcurrentPublish(f"version {entry['version']} of {root} was published by another run")
    try:
        _put(fs, new, json.dumps(entry) + "\n")
        if not _take_lock(fs, lock, probe, lambda: _whole(spark, fs, final)):
            raise refused
        try:
            if _whole(spark, fs, final):
                raise refused
            if fs.exists(final):  # cut off
                fs.delete(final, False)
            if not fs.rename(new, final):
                raise refused
        finally:
            fs.delete(lock, False)
    finally:
        for path in (new, probe):
            if fs.exists(path):
                fs.delete(path, False)


def expire_versions(spark: SparkSession, root: str, keep: int = 3) -> list[int]:
    """Delete committed versions older than the newest ``keep`` (the live one
    always stays): their log entries, staged inputs, and the parts that no kept
    version uses. Returns the deleted version numbers.

    Deletion goes through the Hadoop file system of the path, so it works on
    any store Spark writes to."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    log = version_log(spark, root)
    if log is None:
        return []
    entries = log.select("version", "parts", "staged").collect()
    cutoff = max((r["version"] for r in entries), default=0) - keep + 1
    old = sorted((r for r in entries if r["version"] < cutoff), key=lambda r: r["version"])
    used = {p["path"] for r in entries if r["version"] >= cutoff for p in r["parts"]}
    gone = {p["path"] for r in old for p in r["parts"]} - used
    for r in old:  # the entry first: a version without all its parts is never listed
        delete_path(spark, os.path.join(root, LOG_DIR, f"{r['version']:010d}.json"))
        delete_path(spark, staging_path(root, r["staged"] or f"version={r['version']}"))
    for path in sorted(gone):
        delete_path(spark, os.path.join(root, path))
    kept = [r for r in entries if r["version"] >= cutoff]
    homes = {p["path"].split("/")[0] for r in kept for p in r["parts"]}
    staged = {r["staged"] or f"version={r['version']}" for r in kept}
    _sweep(spark, root, lambda name: name.startswith("version=") and name not in homes)
    _sweep(spark, os.path.join(root, STAGING_DIR), lambda name: name not in staged)
    return [r["version"] for r in old]


def _sweep(spark: SparkSession, folder: str, unused: Callable[[str], bool]) -> None:
    """Delete unused directories that have stood for ``ORPHAN_HOURS``: what ended runs have left."""
    path, fs = file_system(spark, folder)
    if not fs.exists(path):
        return
    limit = (time.time() - 3600 * ORPHAN_HOURS) * 1000
    for status in fs.listStatus(path):
        if status.isDirectory() and status.getModificationTime() < limit and unused(status.getPath().getName()):
            fs.delete(status.getPath(), True)


def publish(
    df: DataFrame,
    root: str,
    single_file: bool = False,
    max_records_per_file: int | None = None,
    source: str | None = None,
    format: str = "parquet",
    watermark_column: str | None = None,
    listed_at: str | None = None,
    key: str | None = None,
    buckets: int | None = None,
    changed: list[int] | None = None,
    based_on: int | None = None,
    staged: str | None = None,
    target_file_bytes: int | None = None,
) -> tuple[int, int]:
    """Write ``df`` as the next version and commit it; returns (version, rows).

    ``based_on`` is the version that ``df`` was made from (default: the live one; 0
    for none): if another has been published since, this one is refused. The row
    count and, with ``watermark_column``, that column's maximum are read from the
    written files and recorded in the commit log, as is ``staged``, the run that
    staged the inputs. ``target_file_bytes`` caps the size of the files. With ``key`` and ``buckets`` the table is bucketed; ``changed``
    then names the buckets that ``df`` replaces (default: all)."""
    from tessera.sinks.writer import write

    spark = df.sparkSession
    before = live(spark, root)
    base = (before.version if before else 0) if based_on is None else based_on
    if (before.version if before else 0) != base:
        raise ConcurrentPublish(f"version {base + 1} of {root} was published by another run")
    version = base + 1
    home = f"version={version}-{new_run()}"
    out = df
    if buckets:
        out = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
    write(
        out,
        os.path.join(root, home),
        format=format,
        mode="errorifexists",
        single_file=single_file,
        max_records_per_file=max_records_per_file,
        partition_by=[BUCKET] if buckets else None,
        target_file_bytes=target_file_bytes,
    )
    found = _written(spark, os.path.join(root, home), out.schema, format, watermark_column, BUCKET if buckets else None)
    rows = sum(r["rows"] for r in found)
    row_bytes = stored_bytes(spark, os.path.join(root, home)) / rows if rows else None
    watermark = max((r["watermark"] for r in found if r["watermark"] is not None), default=None)
    if not buckets:
        parts = [{"bucket": WHOLE, "path": home, "rows": rows}]
    else:
        parts = [{"bucket": r["part"], "path": f"{home}/{BUCKET}={r['part']}", "rows": r["rows"]} for r in found]
        if changed is not None and before is not None:
            if before.buckets != buckets:
                raise ValueError(f"the table has {before.buckets} buckets, not {buckets}")
            kept = [p.asDict() for p in before.parts if p["bucket"] not in set(changed)]
            parts = sorted([*kept, *parts], key=lambda p: p["bucket"])
            watermark = max(filter(None, (watermark, before.watermark)), default=None)
            rows = sum(p["rows"] for p in parts)
        if not parts:  # an empty version still needs a readable part
            write(df.limit(0), os.path.join(root, home, "empty"), format=format, mode="errorifexists")
            parts = [{"bucket": WHOLE, "path": f"{home}/empty", "rows": 0}]
    entry = {
        "version": version,
        "rows": rows,
        "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "source": source,
        "watermark": watermark,
        "listed_at": listed_at,
        "buckets": buckets or 0,
        "parts": parts,
        "staged": staged,
        "row_bytes": row_bytes,
    }
    try:
        _commit(spark, root, entry)
    except ConcurrentPublish:
        delete_path(spark, os.path.join(root, home))
        raise
    return version, rows


def _written(spark: SparkSession, path: str, schema: T.StructType, format: str, ts: str | None, by: str | None) -> list:
    """(part, rows, watermark) of the files under ``path``: one row, or one for each value of ``by``.

    Counts come from the files' own metadata; with a ``ts`` that one column is read."""
    files = spark.read.schema(schema).format(format).load(path)
    latest = (F.max(ts).cast("string") if ts else F.lit(None).cast("string")).alias("watermark")
    part = (F.col(by) if by else F.lit(WHOLE)).alias("part")
    return files.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), latest).collect()
