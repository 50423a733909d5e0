"""File-set sources: changed-file discovery, schema normalisation, probes."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tessera.sources import files


def _write(spark, path, n, offset=0):
    spark.range(offset, offset + n).select(F.col("id"), (F.col("id") * 2).alias("v")).coalesce(1).write.parquet(path)


def _age(path, hours):
    t = time.time() - hours * 3600
    for f in glob.glob(os.path.join(path, "*")) + [path]:
        os.utime(f, (t, t))


def test_changed_files_by_mtime(spark, tmp_path):
    root = tmp_path / "drop"
    for name, hours, off in (("new", 0, 0), ("recent", 3, 100), ("old", 30, 200)):
        _write(spark, str(root / name), 5, off)
        _age(str(root / name), hours)
    schema = spark.read.parquet(str(root / "new")).schema
    since = files.since_hours_ago(24)
    got = files.read_changed_files(spark, str(root), since, schema)
    assert got.count() == 10
    assert got.agg(F.max("id")).first()[0] < 200
    # Nothing newer than now: a typed empty table, not an error.
    none = files.read_changed_files(spark, str(root), files.since_hours_ago(-1), schema)
    assert none.count() == 0 and none.schema == schema


def test_changed_files_boundary_is_strict(spark, tmp_path):
    path = str(tmp_path / "one")
    _write(spark, path, 3)
    stamp = dt.datetime(2024, 5, 1, 12, 0, 0, tzinfo=dt.timezone.utc).timestamp()
    for f in glob.glob(os.path.join(path, "*")):
        os.utime(f, (stamp, stamp))
    schema = spark.read.parquet(path).schema
    assert files.read_changed_files(spark, path, "2024-05-01T12:00:00", schema).count() == 0
    assert files.read_changed_files(spark, path, "2024-05-01T11:59:59", schema).count() == 3


def test_mixed_type_files_read_as_one_table(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    spark.range(3, 6).select(F.col("id").cast("double").alias("id")).write.parquet(b)
    out = files.read_files(spark, [a, b], spark.createDataFrame([], "id double").schema)
    assert sorted(r["id"] for r in out.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_reordered_and_missing_columns_conform(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "id bigint, s string").write.parquet(a)
    spark.createDataFrame([("y", 2)], "s string, id bigint").write.parquet(b)
    c = str(tmp_path / "c")
    spark.createDataFrame([(3,)], "id bigint").write.parquet(c)
    out = files.read_files(spark, [a, b, c], spark.createDataFrame([], "id bigint, s string").schema)
    assert sorted((r["id"], r["s"]) for r in out.collect()) == [(1, "x"), (2, "y"), (3, None)]


def test_empty_input_is_a_typed_empty_table(spark):
    schema = spark.createDataFrame([], "id bigint").schema
    out = files.read_files(spark, [], schema)
    assert out.count() == 0 and out.schema == schema


def test_target_probe(spark, tmp_path):
    assert not files.target_exists(spark, str(tmp_path / "missing"))
    os.makedirs(tmp_path / "empty")
    assert not files.target_exists(spark, str(tmp_path / "empty"))
    _write(spark, str(tmp_path / "t"), 2)
    assert files.target_exists(spark, str(tmp_path / "t"))


def test_single_scan_fast_path(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    spark.range(3, 5).write.parquet(b)
    schema = spark.createDataFrame([], "id bigint").schema
    out = files.read_files(spark, [a, b], schema, group_by_schema=False)
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2, 3, 4]


def test_changed_files_with_drifting_types(spark, tmp_path):
    root = tmp_path / "drop"
    spark.range(3).write.parquet(str(root / "clean_day"))
    spark.range(3, 5).select(F.col("id").cast("double").alias("id")).write.parquet(str(root / "dirty_day"))
    spark.range(100, 102).write.parquet(str(root / "old_day"))
    _age(str(root / "old_day"), 30)
    schema = spark.createDataFrame([], "id double").schema
    got = files.read_changed_files(spark, str(root), files.since_hours_ago(24), schema)
    assert sorted(r["id"] for r in got.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert got.schema == schema


def test_drop_folder_reports_other_objects(spark, tmp_path):
    root = tmp_path / "drop"
    spark.range(3).coalesce(1).write.parquet(str(root / "day1"))
    (root / "day1" / "notes.txt").write_text("not a table")
    # A Parquet object counts whatever its name.
    part = glob.glob(str(root / "day1" / "part-*.parquet"))[0]
    os.makedirs(root / "day2")
    (root / "day2" / "upload.000").write_bytes(open(part, "rb").read())
    schema = spark.createDataFrame([], "id bigint").schema
    with pytest.raises(files.ForeignFiles, match="notes.txt"):
        files.read_files(spark, [str(root)], schema)
    with pytest.warns(UserWarning, match="notes.txt"):
        assert files.read_files(spark, [str(root)], schema, foreign="skip").count() == 6
    since = files.since_hours_ago(24)
    with pytest.warns(UserWarning, match="notes.txt"):
        assert files.read_changed_files(spark, str(root), since, schema, foreign="skip").count() == 6


def test_every_footer_of_a_folder_counts(spark, tmp_path):
    path = str(tmp_path / "mixed")
    rows = spark.range(100).select("id", (F.col("id") / 4).alias("cost"))
    rows.coalesce(1).write.parquet(path)
    rows.drop("cost").coalesce(1).write.mode("append").parquet(path)
    rows.withColumn("id", F.col("id").cast("double")).coalesce(1).write.mode("append").parquet(path)
    schema = spark.createDataFrame([], "id double, cost double").schema
    got = files.read_files(spark, [path], schema)
    assert got.count() == 300 and got.where("cost is not null").count() == 200
    assert set(files.read_files(spark, [path]).columns) == {"id", "cost"}
    with pytest.warns(UserWarning, match="left out: cost"):
        files.read_files(spark, [path], spark.createDataFrame([], "id double").schema)


def _jobs(spark, build):
    group = f"count-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, tmp_path):
    schema = spark.createDataFrame([], "id double").schema
    jobs = []
    for n in (20, 200):
        path = str(tmp_path / str(n))
        spark.range(0, n, 1, n).write.parquet(path)
        assert len(glob.glob(path + "/*.parquet")) == n
        jobs.append(_jobs(spark, lambda: files.read_files(spark, [path], schema)))
    assert jobs[0] == jobs[1] <= 5


def test_since_text_is_in_the_session_zone():
    now = dt.datetime(2024, 7, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
    assert files.since_hours_ago(24, now) == "2024-06-30T12:00:00"
    assert files.since_hours_ago(0, now, "America/New_York") == "2024-07-01T08:00:00"
