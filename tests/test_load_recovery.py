"""What a load survives: runs that end midway, runs side by side, repeated tasks, stores that only Hadoop reaches."""

import json
import os
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from tessera.plans import fixtures as fx
from tessera.plans import jobs
from tessera.schemas import CALL_RECORD_SCHEMA
from tessera.sinks import publish
from tessera.sources import files
from tessera.sources.files import conform, read_changed_files, read_files, since_hours_ago
from tests.conftest import ROOT, SMALL_SF


class Ended(Exception):
    """The process is gone."""


def _day1(spark):
    records = fx.call_records(spark, SMALL_SF)
    return conform(records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz")), CALL_RECORD_SCHEMA)


def _day2(spark):
    return conform(fx.batch_records(spark, SMALL_SF), CALL_RECORD_SCHEMA)


# ---------------------------------------------------------------- commit


@pytest.mark.parametrize("step", ["write", "_put", "_take_lock", "rename", "release"])
def test_a_run_that_ends_at_any_step_blocks_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "table")
    publish.publish(spark.range(3), root)

    def ends(*a, **k):
        raise Ended

    with monkeypatch.context() as m:
        real = publish.file_system

        class Dying:
            """A file system whose process ends at a call; nothing after it happens, clean-up included."""

            def __init__(self, fs):
                self.fs, self.dead = fs, False

            def __getattr__(self, name):
                def call(*a):
                    if self.dead:
                        raise Ended
                    if name == "rename" and step == "rename" or name == "delete" and step == "release":
                        self.dead = True
                        raise Ended
                    return getattr(self.fs, name)(*a)

                return call

        if step == "write":
            m.setattr("tessera.sinks.writer.write", ends)
        elif step in ("rename", "release"):
            fs = {}

            def dying(s, at):
                path, under = real(s, at)
                return path, fs.setdefault("one", Dying(under))

            m.setattr(publish, "file_system", dying)
        else:
            m.setattr(publish, step, ends)
        with pytest.raises(Exception):
            publish.publish(spark.range(5), root)
    done = step == "release"  # the entry had been renamed
    assert publish.current_version(spark, root) == (2 if done else 1)
    assert publish.read_current(spark, root).count() == (5 if done else 3)
    monkeypatch.setattr(publish, "LEASE", 0.0)  # the lock that the ended run has left is old enough
    assert publish.publish(spark.range(4), root) == (3 if done else 2, 4)
    assert publish.read_current(spark, root).count() == 4


@pytest.mark.parametrize("text", ["", '{"version": 2, "rows": 9, "pa', "no json"])
def test_a_cut_off_entry_counts_as_absent(spark, tmp_path, text):
    root = str(tmp_path / "table")
    publish.publish(spark.range(3), root)
    (tmp_path / "table" / "_versions" / "0000000002.json").write_text(text)
    assert publish.current_version(spark, root) == 1
    assert publish.publish(spark.range(4), root) == (2, 4)
    assert json.loads((tmp_path / "table" / "_versions" / "0000000002.json").read_text())["rows"] == 4


def test_a_lock_in_use_is_waited_for(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    publish.publish(spark.range(3), root)
    lock = tmp_path / "table" / "_versions" / ".0000000002.lock"
    lock.write_text("")
    naps = []

    class Clock:
        time = staticmethod(time.time)

        @staticmethod
        def sleep(seconds):
            naps.append(seconds)
            lock.unlink()

    monkeypatch.setattr(publish, "time", Clock)
    assert publish.publish(spark.range(4), root) == (2, 4)
    assert len(naps) == 1


def test_what_ended_runs_left_is_swept(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    publish.publish(spark.range(3), root)
    spark.range(2).write.parquet(f"{root}/version=2-ended")
    spark.range(2).write.parquet(f"{root}/_staging/ended")
    publish.publish(spark.range(4), root)
    publish.expire_versions(spark, root)
    assert os.path.exists(f"{root}/version=2-ended")  # could still be running
    monkeypatch.setattr(publish, "ORPHAN_HOURS", -1.0)
    publish.expire_versions(spark, root)
    assert not os.path.exists(f"{root}/version=2-ended") and not os.path.exists(f"{root}/_staging/ended")
    assert publish.read_current(spark, root).count() == 4


# ---------------------------------------------------------------- runs side by side


@pytest.mark.parametrize("buckets", [None, 4])
def test_of_two_interleaved_runs_one_is_refused(spark, tmp_path, monkeypatch, buckets):
    """The second run stages, merges and publishes while the first is between staging and publishing."""
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    _day1(spark).write.parquet(f"{src}/day1")
    jobs.run_load(spark, src, tgt, buckets=buckets)
    before = publish.live(spark, tgt)
    half = F.pmod(F.col("id"), F.lit(2)) == 0
    first, second = _day2(spark).where(half), _day2(spark).where(~half)
    real, won = jobs.publish, []

    def late(*a, **k):
        monkeypatch.setattr(jobs, "publish", real)
        won.append(jobs.merge_and_publish(spark, before, second, tgt))
        return real(*a, **k)

    monkeypatch.setattr(jobs, "publish", late)
    with pytest.raises(publish.ConcurrentPublish):
        jobs.merge_and_publish(spark, before, first, tgt)
    assert won[0].published_version == 2 == publish.current_version(spark, tgt)
    alone = str(tmp_path / "alone")
    jobs.run_load(spark, src, alone, buckets=buckets)
    jobs.merge_and_publish(spark, publish.live(spark, alone), second, alone)
    rows = lambda root: sorted(map(str, publish.read_current(spark, root).collect()))
    bad = lambda root: sorted(map(str, jobs.rejected_rows(spark, root, 2).collect()))
    assert rows(tgt) == rows(alone) and bad(tgt) == bad(alone) != []
    assert len(os.listdir(f"{tgt}/_staging")) == 2  # the refused run's rows are gone


def test_reject_causes_read_the_mask_only(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    _day1(spark).write.parquet(f"{src}/day1")
    result = jobs.run_load(spark, src, tgt)
    causes = jobs.reject_causes(spark, tgt, result.published_version)
    plan = causes._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<failed_rules:bigint>" in plan
    rows = jobs.rejected_rows(spark, tgt, 1)
    got = {r["rule"]: (r["n_failed"], r["n_only"]) for r in causes.collect()}
    assert len(got) == 14
    for k, name in enumerate(r.name for r in jobs.CALL_RECORD_RULES):
        failed = rows.where(F.col("failed_rules").bitwiseAND(F.lit(1 << k)) != 0).count()
        assert got[name] == (failed, rows.where(F.col("failed_rules") == 1 << k).count())
    first = rows.groupBy("failed_rule").count().collect()
    from tessera.functions.casts import cast_call_records
    from tessera.operators.rules import reject_summary

    assert sorted(map(tuple, first)) == sorted(map(tuple, reject_summary(cast_call_records(_day1(spark))).collect()))


# ---------------------------------------------------------------- repeated tasks


def test_counts_survive_repeated_tasks(tmp_path):
    """Every task of the write fails once after reading its rows; the recorded counts are the files'."""
    code = f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    from tessera.sinks import publish
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "3").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    def once(batches):
        from pyspark import TaskContext
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
    rows = spark.range(0, 1000, 1, 4).mapInArrow(once, "id long").selectExpr("id", "timestamp_seconds(id) as updated_at")
    print("GOT", publish.publish(rows, {str(tmp_path / 'plain')!r}, watermark_column="updated_at"))
    print("GOT", publish.publish(rows, {str(tmp_path / 'buckets')!r}, key="id", buckets=4))
    print("MARK", publish.published_watermark(spark, {str(tmp_path / 'plain')!r}))
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300, env={**os.environ, "TZ": "UTC"})
    assert out.stdout.count("GOT (1, 1000)") == 2, out.stdout + out.stderr[-2000:]
    assert "MARK 1970-01-01 00:16:39" in out.stdout


# ---------------------------------------------------------------- stores that only Hadoop reaches


@pytest.fixture
def mounted(spark, tmp_path):
    """``tmp_path`` under a scheme that no library but Hadoop's knows."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = f"t{abs(hash(str(tmp_path)))}"
    conf.set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}")
    return f"viewfs://{name}/in"


def test_a_load_through_a_scheme_only_hadoop_knows(spark, tmp_path, mounted):
    _day1(spark).write.parquet(str(tmp_path / "src/day1"))
    drifted = _day2(spark).withColumn("call_duration_seconds", F.col("call_duration_seconds").cast("string")).drop("city")
    first = jobs.run_load(spark, f"{mounted}/src", f"{mounted}/tgt")
    assert first.first_run and first.published_version == 1
    drifted.write.parquet(str(tmp_path / "src/day2"))
    second = jobs.run_load(spark, f"{mounted}/src", f"{mounted}/tgt")
    assert second.published_version == 2
    plain = str(tmp_path / "plain")
    jobs.run_load(spark, str(tmp_path / "src/day1"), plain)
    jobs.run_load(spark, str(tmp_path / "src/day2"), plain, since=since_hours_ago(48))
    rows = lambda root: sorted(map(str, publish.read_current(spark, root).collect()))
    assert rows(f"{mounted}/tgt") == rows(plain)


def test_layouts_agree_whichever_way_they_are_read(spark, tmp_path, mounted):
    path = tmp_path / "mixed"
    spark.range(4).write.parquet(str(path / "a"))
    spark.range(4, 8).selectExpr("cast(id as double) as id").write.parquet(str(path / "b b"))
    spark.range(8, 12).selectExpr("id", "'x' as extra").write.parquet(str(path / "c"))
    got = [sorted(map(tuple, read_files(spark, [root]).select(F.col("id").cast("long"), "extra").collect())) for root in (str(path), f"{mounted}/mixed")]
    assert got[0] == got[1] and len(got[0]) == 12
    (path / "a" / "note.txt").write_text("not parquet at all")
    for root in (str(path), f"{mounted}/mixed"):
        with pytest.raises(files.ForeignFiles, match="note.txt"):
            read_files(spark, [root])
        with pytest.warns(UserWarning, match="note.txt"):
            assert read_files(spark, [root], foreign="skip").count() == 12


@pytest.mark.parametrize("drift", [False, True])
def test_discovery_takes_the_same_jobs_for_any_number_of_files(spark, tmp_path, mounted, drift):
    def jobs_for(n):
        for k in range(n):
            kind = "double" if drift and k % 2 else "long"
            spark.range(3).selectExpr(f"cast(id as {kind}) as id").coalesce(1).write.parquet(str(tmp_path / f"n{n}{drift}/{k}"))
        group = f"discover-{n}-{drift}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            df = read_files(spark, [f"{mounted}/n{n}{drift}"])
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert df.count() == 3 * n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs_for(4) == jobs_for(24)


# ---------------------------------------------------------------- files left out by their footers


@pytest.mark.parametrize("through", ["path", "hadoop"])
def test_files_at_or_below_the_watermark_are_not_scanned(spark, tmp_path, mounted, through):
    import datetime as dt

    bound = dt.datetime(2024, 1, 10)
    rows = spark.range(40).select("id", (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id").cast("int"))).cast("timestamp_ntz").alias("updated_at"))
    parts = {"old": "id < 5", "at": "id between 5 and 9", "over": "id between 8 and 12", "new": "id > 20"}
    for name, where in parts.items():
        rows.where(where).coalesce(1).write.parquet(str(tmp_path / "src" / name))
    rows.where("id < 3").withColumn("updated_at", F.lit(None).cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "src/none"))
    rows.where("id < 3").withColumn("updated_at", F.col("updated_at").cast("string")).coalesce(1).write.parquet(str(tmp_path / "src/text"))
    root = str(tmp_path / "src") if through == "path" else f"{mounted}/src"
    schema = rows.schema
    whole = read_changed_files(spark, root, since_hours_ago(24), schema)
    some = read_changed_files(spark, root, since_hours_ago(24), schema, newer_than=("updated_at", bound))
    opened = {f.split("/")[-2] for f in some.inputFiles()}
    assert opened >= {"over", "new", "text"} and not opened & {"old", "at"}
    after = lambda df: sorted(map(tuple, df.where(F.col("updated_at") > F.lit(bound)).collect()))
    assert after(whole) == after(some) != []


def test_a_relisted_folder_opens_new_files_only(spark, tmp_path, monkeypatch):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    _day1(spark).coalesce(1).write.parquet(f"{src}/day1")
    jobs.run_load(spark, src, tgt)
    _day2(spark).coalesce(1).write.parquet(f"{src}/day2")
    seen, real = [], jobs.read_changed_files
    monkeypatch.setattr(jobs, "read_changed_files", lambda *a, **k: (seen.append(real(*a, **k)), seen[-1])[1])
    got = jobs.run_load(spark, src, tgt, since=since_hours_ago(24))
    assert got.published_version == 2
    assert {f.split("/")[-2] for f in seen[0].inputFiles()} == {"day2"}
    # With lateness the bound moves back, and day one's file is read again.
    publish.publish(publish.read_current(spark, tgt), str(tmp_path / "again"), watermark_column="updated_at")
    jobs.run_load(spark, src, str(tmp_path / "again"), since=since_hours_ago(24), allowed_lateness="400 days")
    assert {f.split("/")[-2] for f in seen[1].inputFiles()} == {"day1", "day2"}
