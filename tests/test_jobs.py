"""The two jobs end to end, and the streaming form of the load."""

import glob
import os
import time

from pyspark.sql import functions as F

from tessera.functions.casts import cast_call_records
from tessera.operators.rules import clean
from tessera.plans import fixtures as fx
from tessera.plans.jobs import MOST_BUCKETS, buckets_for, rejected_rows, run_load, run_sales
from tessera.schemas import CALL_RECORD_SCHEMA
from tessera.sinks import publish
from tessera.sources.files import conform, since_hours_ago
from tessera.streaming.incremental import start_incremental_load
from tests.conftest import SMALL_SF


def _drop(spark, df, path, hours_ago=0.0):
    conform(df, CALL_RECORD_SCHEMA).coalesce(1).write.parquet(path)
    t = time.time() - hours_ago * 3600
    for f in glob.glob(os.path.join(path, "*")):
        os.utime(f, (t, t))


def test_run_sales_returns_four_frames(spark):
    out = run_sales(spark, 2000, seed=3)
    assert set(out) == {"latest_order_date", "category_totals", "region_state_totals", "ship_mode_delay"}
    assert out["region_state_totals"].count() == 24


def test_run_load_first_then_incremental(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    target_part = fx.call_records(spark, SMALL_SF).filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz"))
    batch_part = fx.batch_records(spark, SMALL_SF)
    _drop(spark, target_part, f"{src}/day1", hours_ago=30)

    first = run_load(spark, src, tgt)
    assert first.first_run and first.published_version == 1
    v1 = publish.read_current(spark, tgt)
    assert v1.groupBy("id").count().filter("count > 1").count() == 0
    # The first run keeps its rejects with the first rule each failed.
    assert rejected_rows(spark, tgt, 1).count() == first.rows_rejected
    from tessera.operators.rules import rejects as gate_rejects

    first_input = conform(target_part, CALL_RECORD_SCHEMA)
    assert first.rows_changed == first_input.count()
    assert first.rows_rejected == gate_rejects(cast_call_records(first_input)).count() > 0

    # Nothing new since the last listing: the live version stays.
    assert run_load(spark, src, tgt).published_version is None
    # Files re-listed by a wide window, but no row newer than the target:
    # still no new version.
    assert run_load(spark, src, tgt, since=since_hours_ago(48)).published_version is None

    _drop(spark, batch_part, f"{src}/day2", hours_ago=1)
    second = run_load(spark, src, tgt, since=since_hours_ago(24))
    assert not second.first_run and second.published_version == 2
    # An incremental run keeps its rejects with the first rule each failed.
    got = rejected_rows(spark, tgt, 2)
    assert got.count() == second.rows_rejected > 0
    assert got.filter("failed_rule is null").count() == 0
    v2 = publish.read_current(spark, tgt)
    assert v2.count() == second.rows_published
    assert v2.groupBy("id").count().filter("count > 1").count() == 0
    assert v2.count() >= v1.count()


def test_streaming_load_processes_each_file_once(spark, tmp_path):
    src, tgt, ckpt = str(tmp_path / "src"), str(tmp_path / "tgt"), str(tmp_path / "ckpt")
    records = fx.call_records(spark, SMALL_SF)
    _drop(spark, records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz")), f"{src}/a")
    q = start_incremental_load(spark, src + "/*", tgt, ckpt)
    q.awaitTermination()
    v1 = publish.current_version(spark, tgt)
    assert v1 == 1
    # No new file: a new run publishes nothing.
    start_incremental_load(spark, src + "/*", tgt, ckpt).awaitTermination()
    assert publish.current_version(spark, tgt) == 1
    _drop(spark, fx.batch_records(spark, SMALL_SF), f"{src}/b")
    start_incremental_load(spark, src + "/*", tgt, ckpt).awaitTermination()
    assert publish.current_version(spark, tgt) == 2
    out = publish.read_current(spark, tgt)
    assert out.groupBy("id").count().filter("count > 1").count() == 0


def test_empty_published_target_loads_like_a_first_run(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    records = fx.call_records(spark, SMALL_SF)
    empty = conform(records.filter(F.lit(False)), CALL_RECORD_SCHEMA)
    publish.publish(empty, tgt)
    _drop(spark, records, f"{src}/day1", hours_ago=1)
    result = run_load(spark, src, tgt)
    assert result.first_run and result.published_version == 2
    fresh = run_load(spark, src, str(tmp_path / "fresh"))
    assert result.rows_published == fresh.rows_published > 0


def test_streaming_load_into_an_empty_target(spark, tmp_path):
    src, tgt, ckpt = str(tmp_path / "src"), str(tmp_path / "tgt"), str(tmp_path / "ckpt")
    records = fx.call_records(spark, SMALL_SF)
    publish.publish(conform(records.filter(F.lit(False)), CALL_RECORD_SCHEMA), tgt)
    _drop(spark, records, f"{src}/a")
    start_incremental_load(spark, src + "/*", tgt, ckpt).awaitTermination()
    assert publish.current_version(spark, tgt) == 2
    assert publish.read_current(spark, tgt).count() > 0


def _rows(spark, tgt):
    return sorted(map(str, publish.read_current(spark, tgt).collect()))


def test_a_batch_of_rejects_publishes_nothing(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    records = fx.call_records(spark, SMALL_SF)
    _drop(spark, records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz")), f"{src}/day1", 30)
    run_load(spark, src, tgt)
    bad = fx.batch_records(spark, SMALL_SF).withColumn("currency", F.lit("none"))
    _drop(spark, bad, f"{src}/day2")
    result = run_load(spark, src, tgt, since=since_hours_ago(1))
    assert result.published_version is None and result.rows_changed == result.rows_rejected > 0
    assert publish.current_version(spark, tgt) == 1


def test_a_late_run_starts_at_the_last_listing(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    records = fx.call_records(spark, SMALL_SF)
    _drop(spark, records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz")), f"{src}/day1", 90)
    run_load(spark, src, tgt)
    _drop(spark, fx.batch_records(spark, SMALL_SF), f"{src}/day2")
    # A window of no hours would miss the new files; the recorded listing doesn't.
    assert run_load(spark, src, tgt, window_hours=0).published_version == 2


def test_allowed_lateness_lets_late_rows_in(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    records = fx.call_records(spark, SMALL_SF)
    _drop(spark, records, f"{src}/day1", 30)
    run_load(spark, src, tgt)
    newest = F.lit(publish.published_watermark(spark, tgt)).cast("timestamp_ntz")
    late = records.where("id = 3").limit(1).withColumn("updated_at", newest - F.expr("interval 1 hour"))
    _drop(spark, late, f"{src}/day2")
    since = since_hours_ago(1)
    assert run_load(spark, src, tgt, since=since).rows_changed == 0
    assert run_load(spark, src, tgt, since=since, allowed_lateness="2 hours").rows_changed == 1


def test_a_bucketed_target_holds_the_same_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    plain, buckets = str(tmp_path / "plain"), str(tmp_path / "buckets")
    records = fx.call_records(spark, SMALL_SF)
    _drop(spark, records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz")), f"{src}/day1", 30)
    run_load(spark, src, plain)
    run_load(spark, src, buckets, buckets=16)
    assert _rows(spark, plain) == _rows(spark, buckets)
    before = {p["bucket"]: p["path"] for p in publish.live(spark, buckets).parts}
    batch = fx.batch_records(spark, SMALL_SF)
    newest = clean(cast_call_records(batch)).orderBy(F.col("updated_at").desc()).limit(3)
    some = batch.where(F.col("id").isin([r["id"] for r in newest.collect()]))
    _drop(spark, some, f"{src}/day2")
    since = since_hours_ago(1)
    for root in (plain, buckets):
        assert run_load(spark, src, root, since=since).published_version == 2
    assert _rows(spark, plain) == _rows(spark, buckets)
    after = {p["bucket"]: p["path"] for p in publish.live(spark, buckets).parts}
    assert 0 < sum(before.get(b) != p for b, p in after.items()) < 16


def test_a_target_that_outgrows_its_buckets_is_dealt_to_more(spark, tmp_path):
    """The load chooses the buckets by size, on the first run and later; the rows stay the same."""
    src = str(tmp_path / "src")
    roots = {k: str(tmp_path / k) for k in ("whole", "kept", "grown", "first")}
    records = fx.call_records(spark, SMALL_SF)
    day = lambda d: F.col("updated_at") < F.lit(d).cast("timestamp_ntz")
    _drop(spark, records.filter(day(fx.TARGET_BEFORE)), f"{src}/day1", 30)
    size = publish.stored_bytes(spark, src)
    first = {"whole": {}, "kept": {"buckets": 2}, "grown": {}, "first": {"bucket_bytes": size // 3}}
    for k, root in roots.items():
        run_load(spark, src, root, **first[k])
    assert {k: publish.live(spark, r).buckets for k, r in roots.items()} == {"whole": 0, "kept": 2, "grown": 0, "first": 4}
    held = publish.live(spark, roots["grown"]).n_bytes
    assert 0 < held <= publish.stored_bytes(spark, roots["grown"])
    _drop(spark, fx.batch_records(spark, SMALL_SF), f"{src}/day2")
    since = since_hours_ago(1)
    later = {"whole": {"buckets": 0, "bucket_bytes": 1}, "kept": {"buckets": 2, "bucket_bytes": 1}, "grown": {"bucket_bytes": held // 3}}
    later["first"] = {"bucket_bytes": held // 40}
    for k, root in roots.items():
        assert run_load(spark, src, root, since=since, **later[k]).published_version == 2
        assert _rows(spark, root) == _rows(spark, roots["whole"])
    after = {k: publish.live(spark, r).buckets for k, r in roots.items()}
    assert after["whole"] == 0 and after["kept"] == 2
    assert after["grown"] >= 4 and after["first"] >= 32
    spread = [p["bucket"] for p in publish.live(spark, roots["first"]).parts]
    assert len(spread) == len(set(spread)) and max(spread) < after["first"]


def test_buckets_follow_the_bytes():
    assert [buckets_for(n, 10) for n in (0, 10, 11, 40, 41, 10**9)] == [0, 0, 2, 4, 8, MOST_BUCKETS]


def test_a_second_checkpoint_loses_nothing(spark, tmp_path):
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    records = fx.call_records(spark, SMALL_SF)
    _drop(spark, records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz")), f"{src}/a")
    start_incremental_load(spark, src + "/*", tgt, str(tmp_path / "one")).awaitTermination()
    other = str(tmp_path / "other")
    _drop(spark, fx.batch_records(spark, SMALL_SF), f"{other}/b")
    start_incremental_load(spark, other + "/*", tgt, str(tmp_path / "two")).awaitTermination()
    assert publish.current_version(spark, tgt) == 2
    expected = str(tmp_path / "expected")
    start_incremental_load(spark, src + "/*", expected, str(tmp_path / "x")).awaitTermination()
    _drop(spark, fx.batch_records(spark, SMALL_SF), f"{src}/b")
    start_incremental_load(spark, src + "/*", expected, str(tmp_path / "x")).awaitTermination()
    assert _rows(spark, tgt) == _rows(spark, expected)


def test_stream_of_file_names_takes_drifting_types(spark, tmp_path):
    src, tgt, ckpt = str(tmp_path / "src"), str(tmp_path / "tgt"), str(tmp_path / "ckpt")
    records = fx.call_records(spark, SMALL_SF).filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz"))
    for k, kind in enumerate(("double", "string", "int")):
        rows = conform(records, CALL_RECORD_SCHEMA).where(F.pmod(F.xxhash64("subscriber_id", "sim_card_number"), F.lit(3)) == k)
        rows.withColumn("message_length", F.col("message_length").cast(kind)).write.parquet(f"{src}/f{k}")
    for _ in range(2):  # the second start finds nothing new
        start_incremental_load(spark, src + "/*", tgt, ckpt, by_file=True).awaitTermination()
        assert publish.current_version(spark, tgt) == 1
    plain = str(tmp_path / "plain")
    run_load(spark, src, plain)
    assert _rows(spark, tgt) == _rows(spark, plain) != []
    (tmp_path / "src" / "g").mkdir()
    (tmp_path / "src" / "g" / "note.txt").write_text("not parquet")
    q = start_incremental_load(spark, src + "/*", tgt, ckpt, by_file=True, foreign="skip")
    q.awaitTermination()
    assert publish.current_version(spark, tgt) == 1


def test_a_late_version_of_a_quiet_id_is_kept_by_the_state(spark, tmp_path):
    from tessera.streaming.incremental import latest_versions, start_latest_versions

    schema = "id long, updated_at timestamp_ntz, v string, arrived int"
    days = [
        [(1, "2024-05-01", "a"), (2, "2024-01-01", "b"), (2, None, "b0"), (None, "2024-01-01", "n"), (4, None, "q")],
        [(2, "2024-01-02", "late"), (1, "2024-05-01", "same time"), (3, "2020-01-01", "old"), (4, None, "p"), (1, "2024-04-30", "older")],
        [(3, None, "no time"), (4, "2020-01-01", "first time")],
    ]
    for k, rows in enumerate(days, 1):
        df = spark.createDataFrame(rows, "id long, t string, v string").selectExpr("id", "cast(t as timestamp_ntz) updated_at", "v", f"{k} arrived")
        df.coalesce(1).write.parquet(str(tmp_path / f"src/{k}"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "src/*"))
        start_latest_versions(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = latest_versions(spark, str(tmp_path / "out"))
    assert got.columns == ["id", "updated_at", "v"]
    assert {r["id"]: r["v"] for r in got.collect()} == {1: "a", 2: "late", 3: "old", 4: "first time"}
