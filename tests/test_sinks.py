"""Writers, create-only writes, versioned publish, metrics."""

import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.sinks import publish, writer


def test_write_modes_and_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    path = str(tmp_path / "out")
    assert writer.write(df, path, single_file=True)
    assert len(glob.glob(os.path.join(path, "part-*"))) == 1
    with pytest.raises(AnalysisException):
        writer.write_new(df, path)
    assert writer.write(None, path) is False
    assert spark.read.parquet(path).count() == 100


def test_counted_fills_during_the_write(spark, tmp_path):
    df, obs = writer.counted(spark.range(42))
    df.write.parquet(str(tmp_path / "c"))
    assert obs.get["rows"] == 42


def test_publish_versions_and_reads_latest(spark, tmp_path):
    root = str(tmp_path / "table")
    assert publish.read_current(spark, root) is None
    assert publish.publish(spark.range(3), root) == (1, 3)
    current = publish.read_current(spark, root)
    # The next version reads the live one and never overwrites it.
    assert publish.publish(current.union(spark.range(3, 5)), root) == (2, 5)
    assert publish.current_version(spark, root) == 2
    assert publish.read_current(spark, root).count() == 5
    assert spark.read.parquet(*publish.version_paths(spark, root, 1)).count() == 3


def test_failed_publish_keeps_the_last_good_version(spark, tmp_path):
    root = str(tmp_path / "table")
    publish.publish(spark.range(3), root)
    boom = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        publish.publish(boom, root)
    assert publish.current_version(spark, root) == 1
    assert publish.read_current(spark, root).count() == 3
    # A later run reuses the uncommitted number.
    assert publish.publish(spark.range(4), root) == (2, 4)
    assert publish.read_current(spark, root).count() == 4


def test_retention_keeps_the_newest_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    for i in range(4):
        publish.publish(spark.range(i + 1), root)
    first, third = publish.version_paths(spark, root, 1)[0], publish.version_paths(spark, root, 3)[0]
    assert publish.expire_versions(spark, root, keep=2) == [1, 2]
    assert not os.path.exists(first)
    assert os.path.exists(third)
    assert publish.read_current(spark, root).count() == 4
    assert publish.expire_versions(spark, root, keep=2) == []
    # The log keeps only the entries of the versions still on disk.
    versions = sorted(r["version"] for r in publish.version_log(spark, root).collect())
    assert versions == [3, 4]
    assert publish.current_version(spark, root) == 4


def test_publish_records_the_watermark(spark, tmp_path):
    import datetime as dt

    root = str(tmp_path / "table")
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 2, 3, 4, 5, 678901)), (2, dt.datetime(2024, 1, 1))], "id bigint, updated_at timestamp_ntz"
    )
    publish.publish(df, root, watermark_column="updated_at")
    recorded = publish.published_watermark(spark, root)
    assert recorded == "2024-01-02 03:04:05.678901"
    back = spark.range(1).select(F.lit(recorded).cast("timestamp_ntz").alias("t")).first()["t"]
    assert back == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    publish.publish(spark.range(2), root)
    assert publish.published_watermark(spark, root) is None


def test_two_writers_of_one_version_publish_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    publish.publish(spark.range(3), root)
    start = publish.live(spark, root)
    assert publish.publish(spark.range(4), root) == (2, 4)
    # A run that started from version 1 loses, and leaves nothing behind.
    monkeypatch.setattr(publish, "live", lambda *a: start)
    before = set(os.listdir(root))
    with pytest.raises(publish.ConcurrentPublish):
        publish.publish(spark.range(9), root)
    monkeypatch.undo()
    assert set(os.listdir(root)) == before
    assert publish.read_current(spark, root).count() == 4


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(os.path.join(path, "*.parquet"))}


def test_bucketed_publish_leaves_other_buckets_alone(spark, tmp_path):
    root = str(tmp_path / "table")
    rows = spark.range(1000).withColumn("v", F.lit(1))
    publish.publish(rows, root, key="id", buckets=8)
    assert publish.read_current(spark, root).count() == 1000
    bucket = spark.range(7, 8).select(publish.bucket_of("id", 8)).first()[0]
    parts = {p["bucket"]: os.path.join(root, p["path"]) for p in publish.live(spark, root).parts}
    kept = {b: _files(p) for b, p in parts.items() if b != bucket}
    one = rows.where(publish.bucket_of("id", 8) == bucket).withColumn("v", F.lit(2))
    version, total = publish.publish(one, root, key="id", buckets=8, changed=[bucket])
    assert (version, total) == (2, 1000)
    now = {p["bucket"]: os.path.join(root, p["path"]) for p in publish.live(spark, root).parts}
    assert {b: _files(p) for b, p in now.items() if b != bucket} == kept
    assert now[bucket] != parts[bucket]
    got = publish.read_current(spark, root)
    assert got.where("v = 2").count() == one.count() and got.distinct().count() == 1000
    # Retention drops the replaced part only.
    assert publish.expire_versions(spark, root, keep=1) == [1]
    assert publish.read_current(spark, root).count() == 1000 and not os.path.exists(parts[bucket])


def test_bucketed_publish_of_nothing_reads_back(spark, tmp_path):
    root = str(tmp_path / "table")
    publish.publish(spark.range(0), root, key="id", buckets=4)
    assert publish.read_current(spark, root).count() == 0


def test_files_are_sized_by_bytes_also_in_a_skewed_bucket(spark, tmp_path):
    from tessera.sinks.writer import bytes_per_row_of, write

    # nine tenths of the rows in one bucket
    rows = spark.range(0, 60_000, 1, 4).select(
        F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id") % 4).alias("b"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )
    rows.write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    size = bytes_per_row_of(staged)
    total = sum(os.path.getsize(f) for f in glob.glob(str(tmp_path / "staged/*.parquet")))
    assert size == total / 60_000
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    write(staged, str(tmp_path / "sized"), partition_by=["b"], target_file_bytes=400_000, bytes_per_row=size)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    files = {f: os.path.getsize(f) for f in glob.glob(str(tmp_path / "sized/*/*.parquet"))}
    assert max(files.values()) < 500_000 and spark.read.parquet(str(tmp_path / "sized")).count() == 60_000
    tasks = {os.path.basename(f).split("-")[1] for f in files if "/b=1/" in f}
    assert len(tasks) >= 4  # the large bucket is not one task's work
    assert bytes_per_row_of(staged.where("false")) is None
