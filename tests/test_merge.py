"""Merge properties: anti join, watermark, policies, idempotence."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.casts import cast_call_records
from tessera.operators import merge, rules
from tessera.plans import fixtures as fx
from tests.conftest import SMALL_SF

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, updated_at timestamp_ntz, v string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_anti_join_keeps_null_ids(spark):
    target = _df(spark, [(1, T0, "a"), (2, T0, "b"), (None, T0, "c")])
    ids = _df(spark, [(1, T0, "x"), (None, T0, "y")])
    got = {(r["id"], r["v"]) for r in merge.unchanged_rows(target, ids).collect()}
    assert got == {(None, "c"), (2, "b")}


def test_watermark_is_strict_and_null_safe(spark):
    target = _df(spark, [(1, T0, "a")])
    batch = _df(spark, [(1, T0, "same"), (2, T0 + dt.timedelta(seconds=1), "newer"), (3, None, "nulltime")])
    assert [r["v"] for r in merge.changed_rows(batch, target).collect()] == ["newer"]
    empty = target.filter(F.lit(False))
    # An empty target's watermark is NULL, which no row passes …
    assert merge.changed_rows(batch, empty).count() == 0
    # … so the load treats an empty target as a first run.
    batch_cdr = fx.call_records(spark, SMALL_SF)
    empty_target = fx.target_records(spark, SMALL_SF).filter(F.lit(False))
    first = merge.merge_incremental(empty_target, batch_cdr, policy="as_coded")
    assert first.count() == merge.merge_incremental(None, batch_cdr, policy="as_coded").count() > 0


def test_latest_per_key_ties_are_deterministic(spark):
    rows = [(1, T0, "b"), (1, T0, "a"), (1, T0 - dt.timedelta(days=1), "0"), (2, None, "n"), (2, T0, "m")]
    for parts in (1, 3):
        df = _df(spark, rows).repartition(parts)
        got = sorted((r["id"], r["v"]) for r in merge.latest_per_key(df).collect())
        assert got == [(1, "a"), (2, "m")]


def test_fixture_counts_match_the_expected_table(spark):
    sf = "/root/testdata/sf0.01"
    target, batch = fx.target_records(spark, sf), fx.batch_records(spark, sf)
    assert target.count() == 6328 and batch.count() == 5332
    changed = merge.changed_rows(batch, target)
    assert changed.count() == 3672
    assert merge.unchanged_rows(target, changed).count() == 2678
    assert merge.merge_as_coded(target, batch).count() == 3695
    unique = merge.merge_unique(merge.latest_per_key(target), batch)
    assert unique.count() == 3990
    assert unique.groupBy("id").count().filter("count > 1").count() == 0


def test_unique_merge_is_idempotent_and_keeps_untouched_rows(spark):
    target = merge.latest_per_key(fx.target_records(spark, SMALL_SF))
    batch = fx.batch_records(spark, SMALL_SF)
    once = merge.merge_unique(target, batch).cache()
    twice = merge.merge_unique(once, batch)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    touched = merge.latest_per_key(
        rules.clean(cast_call_records(merge.changed_rows(batch, target)))
    ).select("id")
    untouched = target.join(touched, "id", "left_anti")
    assert untouched.exceptAll(once).count() == 0
    once.unpersist()


def test_first_run_and_empty_batch(spark):
    batch = fx.call_records(spark, SMALL_SF)
    first = merge.merge_incremental(None, batch, policy="as_coded")
    assert first.count() == rules.clean(cast_call_records(batch)).count()
    target = fx.target_records(spark, SMALL_SF)
    same = merge.merge_incremental(target, batch.filter(F.lit(False)), policy="unique")
    assert same.exceptAll(target).count() == 0 and target.exceptAll(same).count() == 0


def test_per_key_watermark_keeps_late_rows_of_quiet_ids(spark):
    target = _df(spark, [(1, T0, "old1"), (2, T0 + dt.timedelta(days=5), "recent2")])
    batch = _df(
        spark,
        [
            (1, T0 + dt.timedelta(days=1), "late-but-newer-for-1"),
            (2, T0 + dt.timedelta(days=4), "stale-for-2"),
            (3, T0, "new-id"),
        ],
    )
    glob_rows = {r["v"] for r in merge.changed_rows(batch, target).collect()}
    assert glob_rows == set()
    per_key = {r["v"] for r in merge.changed_rows_per_key(batch, target).collect()}
    assert per_key == {"late-but-newer-for-1", "new-id"}
    late = {r["v"] for r in merge.changed_rows(batch, target, allowed_lateness="2 days").collect()}
    assert late == {"stale-for-2"}


def _latest_brute_force(rows, key="id", ts="updated_at"):
    """Plain-Python latest-per-key with the library's ordering."""
    others = sorted(c for c in rows[0].asDict() if c not in (key, ts)) if rows else []

    def order(r):
        d = r.asDict()
        # updated_at desc, nulls last; tie-breakers asc, nulls last.
        parts = [(d[ts] is None, -(d[ts].timestamp()) if d[ts] is not None else 0)]
        parts += [(d[c] is None, d[c] if d[c] is not None else 0) for c in others]
        return parts

    best = {}
    for r in rows:
        k = r[key]
        if k is None:
            continue
        if k not in best or order(r) < order(best[k]):
            best[k] = r
    return {tuple(sorted(r.asDict().items())) for r in best.values()}


def test_hot_key_holding_a_third_of_rows(spark):
    records = fx.call_records(spark, SMALL_SF)
    hot = records.withColumn(
        "id", F.when(F.pmod(F.hash("sim_card_number"), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("id"))
    ).cache()
    n, n_hot = hot.count(), hot.filter("id = 7").count()
    assert n_hot > n / 4
    got = {tuple(sorted(r.asDict().items())) for r in merge.latest_per_key(hot).collect()}
    assert got == _latest_brute_force(hot.collect())
    # The merge with a hot id on both sides still yields one row per id.
    target = merge.latest_per_key(cast_call_records(hot.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz"))))
    batch = hot.filter(F.col("updated_at") >= F.lit(fx.BATCH_FROM).cast("timestamp_ntz"))
    out = merge.merge_unique(target, batch)
    assert out.groupBy("id").count().filter("count > 1").count() == 0
    hot.unpersist()


def test_bitmap_cuts_the_target_before_the_exact_join(spark, monkeypatch):
    target = spark.range(0, 50_000, 1, 4).select(F.when(F.col("id") % 1000 == 1, None).otherwise(F.col("id")).alias("id"), F.lit("x").alias("v"))
    ids = spark.range(0, 50_000, 500)
    want = sorted(map(str, merge.unchanged_rows(target, ids).collect()))
    assert sorted(map(str, merge.unchanged_rows(target, ids, bitmap=True).collect())) == want
    apart, maybe = merge.split_by_bitmap(target, ids)
    assert maybe.count() <= 200 and apart.count() + maybe.count() == 50_000  # 100 ids; hardly any other row is shuffled
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(merge, "BITMAP_WORDS", 1)  # every id shares its word with all others
    assert sorted(map(str, merge.unchanged_rows(target, ids, bitmap=True).collect())) == want
    assert merge.split_by_bitmap(target, ids)[1].count() > 25_000
    none = ids.where("false")
    assert merge.unchanged_rows(target, none, bitmap=True).count() == 50_000
    # ids of another type meet in the join alone
    assert merge.unchanged_rows(target, ids.selectExpr("cast(id as double) as id"), bitmap=True).count() == len(want)
    odd = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (1.5,), (None,)], "id double")
    assert merge.unchanged_rows(odd, spark.createDataFrame([(-0.0,), (float("nan"),)], "id double"), bitmap=True).count() == merge.unchanged_rows(
        odd, spark.createDataFrame([(-0.0,), (float("nan"),)], "id double")
    ).count()
