"""Plan assertions: the physical plans we rely on for scale."""

from tessera.operators import analytics, merge
from tessera.operators.enrich import enrich_sales
from tessera.plans import fixtures as fx
from tests.conftest import SMALL_SF


import contextlib
import io


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_merge_plan_has_anti_join_and_no_python(spark):
    plan = _plan(merge.merge_as_coded(fx.target_records(spark, SMALL_SF), fx.batch_records(spark, SMALL_SF)))
    assert "LeftAnti" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = _plan(merge.latest_per_key(fx.call_records(spark, SMALL_SF)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_aggregations_combine_map_side(spark):
    plan = _plan(analytics.category_totals(enrich_sales(fx.sales_fact(spark, SMALL_SF))))
    assert "partial_sum" in plan


def test_watermark_is_a_subquery_not_a_literal(spark):
    df = merge.changed_rows(fx.batch_records(spark, SMALL_SF), fx.target_records(spark, SMALL_SF))
    assert "Subquery" in _plan(df)


def test_scan_prunes_columns(spark):
    df = fx.sales_fact(spark, SMALL_SF)
    plan = _plan(df)
    assert "l_returnflag" not in plan and "c_acctbal" not in plan


def test_top_k_is_take_ordered(spark):
    df = analytics.top_region_states(enrich_sales(fx.sales_fact(spark, SMALL_SF)))
    assert "TakeOrderedAndProject" in _plan(df)


def test_a_counted_change_set_is_broadcast(spark):
    target = fx.target_records(spark, SMALL_SF)
    changed = merge.changed_rows(fx.batch_records(spark, SMALL_SF), target)
    assert "BroadcastHashJoin LeftAnti" in _plan(merge.unchanged_rows(target, changed, few_ids=True))


@contextlib.contextmanager
def _conf(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_id_is_split_in_the_merge_joins(spark):
    from pyspark.sql import functions as F

    with _conf(spark, **SKEWED):
        # a third of all rows have id 7
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
            F.timestamp_seconds("id").cast("timestamp_ntz").alias("updated_at"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        ids = spark.range(0, 60_000, 5).select("id")
        assert "SortMergeJoin(skew=true)" in _final_plan(merge.unchanged_rows(rows, ids))
        target = rows.where("id % 2 = 1")
        assert "SortMergeJoin(skew=true)" in _final_plan(merge.changed_rows_per_key(rows, target))


def test_building_a_merge_runs_no_jobs(spark):
    target, batch = fx.target_records(spark, SMALL_SF), fx.batch_records(spark, SMALL_SF)
    group = "build-merge"
    spark.sparkContext.setJobGroup(group, group)
    try:
        merge.merge_unique(target, batch)
        merge.merge_unique(target, batch, watermark="per_key")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0


def test_rejects_evaluate_the_rules_once(spark):
    from tessera.functions.casts import cast_call_records
    from tessera.operators.rules import rejects

    df = rejects(cast_call_records(fx.call_records(spark, SMALL_SF)))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 6


def test_clean_pushes_membership_and_id_checks_into_the_scan(spark, tmp_path):
    from tessera.functions.casts import cast_call_records
    from tessera.operators.rules import clean
    from tessera.schemas import CALL_RECORD_SCHEMA
    from tessera.sources.files import conform, read_files

    path = str(tmp_path / "cdr")
    conform(fx.call_records(spark, SMALL_SF), CALL_RECORD_SCHEMA).write.parquet(path)
    plan = _plan(clean(cast_call_records(read_files(spark, [path], CALL_RECORD_SCHEMA))))
    pushed = [l for l in plan.splitlines() if "PushedFilters" in l][0]
    assert "In(call_type" in pushed and "GreaterThan(id" in pushed and "IsNotNull(id)" in pushed


def test_no_registered_query_runs_python(spark):
    from tessera.plans import catalog

    for name, fn in catalog.QUERIES.items():
        if name in ("stream_incremental_load", "batch_incremental_load"):
            continue  # two load runs each; their merge is the one checked above
        plan = _plan(fn(spark, SMALL_SF))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in plan, (name, marker)
