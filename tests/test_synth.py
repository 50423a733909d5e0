"""Generators: shape, ranges, reproducibility; enrichment against rows recomputed in Python."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import analytics
from tessera.operators.enrich import enrich_sales
from tessera.schemas import CALL_RECORD_SCHEMA, SALES_SCHEMA
from tessera.sources import synth


def test_sales_table_has_the_declared_columns(spark):
    df = synth.sales_table(spark, 1000)
    declared = {f.name.lower(): f.dataType for f in SALES_SCHEMA.fields}
    assert {f.name.lower(): f.dataType for f in df.schema.fields} == declared
    rows = df.collect()
    assert len(rows) == 1000
    day = dt.date(2022, 1, 1)
    for r in rows:
        assert 0 <= (r["Order_Date"] - day).days <= 999 and 0 <= (r["Ship_Date"] - r["Order_Date"]).days <= 6
        assert 0 <= r["Sales"] <= 1000 and 1 <= r["Quantity"] <= 10 and -100 <= r["Profit"] <= 400
        assert r["Region"] in synth.REGIONS


def test_enrichment_keeps_exactly_the_profitable_prompt_rows(spark):
    table = synth.sales_table(spark, 1000).withColumn(
        "Ship_Date", F.expr("date_add(Ship_Date, case when row_id % 5 = 0 then 40 else 0 end)")
    )
    expected = {
        r["row_id"]: ((r["Ship_Date"] - r["Order_Date"]).days, r["Profit"] / r["Sales"] if r["Sales"] else 0.0)
        for r in table.collect()
        if r["Profit"] > 0 and (r["Ship_Date"] - r["Order_Date"]).days < 32
    }
    got = {r["row_id"]: (r["shipping_delay"], r["profit_margin"]) for r in enrich_sales(table).collect()}
    assert got == expected and 0 < len(got) < 1000


def test_analytics_run(spark):
    report = analytics.sales_report(enrich_sales(synth.sales_table(spark, 1000)))
    assert report["category_totals"].count() == 3
    assert report["region_state_totals"].count() == 24
    assert report["ship_mode_delay"].count() == 4
    assert report["latest_order_date"].count() == 1


def test_same_seed_same_rows_under_any_partitioning(spark, monkeypatch):
    a = synth.cdr_table(spark, 3000, 40, seed=7)
    monkeypatch.setattr(synth, "ROWS_PER_PARTITION", 100)
    b = synth.cdr_table(spark, 3000, 40, seed=7)
    assert b.rdd.getNumPartitions() >= 30
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = synth.cdr_table(spark, 3000, 40, seed=8)
    assert a.exceptAll(c).count() == 3000


def test_cdr_clean_rows_follow_the_producer_rules(spark):
    df = synth.cdr_table(spark, 4000, 0)
    nullable = {"message_content"}
    for c in df.columns:
        if c not in nullable:
            assert df.filter(F.col(c).isNull()).count() == 0, c
    r = df.agg(
        F.min("id"), F.max("id"), F.min("signal_strength_dbm"), F.max("signal_strength_dbm"),
        F.min("cost"), F.max("cost"), F.min("location_latitude"), F.max("location_latitude"),
        F.min(F.unix_timestamp("call_end_time") - F.unix_timestamp("call_start_time")),
        F.max(F.unix_timestamp("call_end_time") - F.unix_timestamp("call_start_time")),
        F.countDistinct("cell_tower_id"), F.countDistinct("location_area_code"),
    ).first()
    assert 1 <= r[0] and r[1] <= 9_999_999
    assert -120 <= r[2] and r[3] <= -50
    assert 0.01 <= r[4] and r[5] <= 10.0
    assert 4.0 <= r[6] and r[7] < 14.0
    assert 1 <= r[8] and r[9] <= 3600
    assert r[10] <= 500 and r[11] <= 300
    sms = df.filter("call_type = 'sms'")
    assert sms.filter("length(message_content) != message_length or call_duration_seconds != 0").count() == 0
    voice = df.filter("call_type = 'voice'")
    assert voice.filter("message_content is not null or message_length != 0").count() == 0
    from tessera.functions.casts import cast_call_records
    from tessera.operators.rules import clean

    assert clean(cast_call_records(df)).count() == 4000


def test_exact_dirty_count_and_null_rate(spark):
    n, pct = 20000, 40
    df = synth.cdr_table(spark, n, pct)
    # Clean rows never hold NULL ids, so every NULL id comes from a dirty row.
    nulls = df.filter(F.col("id").isNull()).count()
    dirty = int(n * pct / 100)
    expected, sd = dirty * 0.05, (dirty * 0.05 * 0.95) ** 0.5
    assert abs(nulls - expected) < 4 * sd
    # Phone corruption only appears in dirty rows.
    errs = df.filter(F.col("caller_number").startswith("ERROR")).count()
    assert abs(errs - expected) < 4 * sd
    neg = df.filter(F.col("call_duration_seconds") < 0).count()
    assert neg <= dirty * 0.1


def test_one_pass_report_equals_the_single_reports(spark):
    from tessera.plans.fixtures import sales_fact
    from tests.conftest import SMALL_SF

    for table in (synth.sales_table(spark, 5000), sales_fact(spark, SMALL_SF)):
        enriched = enrich_sales(table)
        report = analytics.sales_report(enriched)
        singles = {
            "latest_order_date": analytics.latest_order_date(enriched),
            "category_totals": analytics.category_totals(enriched),
            "region_state_totals": analytics.region_state_totals(enriched),
            "ship_mode_delay": analytics.ship_mode_delay(enriched),
        }
        for name, single in singles.items():
            assert report[name].columns == single.columns, name
            assert report[name].collect() == single.collect(), name


def test_given_rows_are_completed_and_kept(spark):
    drawn = synth.sales_table(spark, 500, seed=3)
    ids = spark.range(100, 500).selectExpr("id as row_id", "date'2024-02-28' as order_date", "cast(id as double) as Sales", "1 as other")
    got = synth.sales_table(spark, seed=3, given=ids)
    assert got.columns == drawn.columns and got.count() == 400
    own = ["Order_Date", "Ship_Date", "Sales"]
    assert sorted(got.drop(*own).collect()) == sorted(drawn.where("row_id >= 100").drop(*own).collect())
    assert got.where("Order_Date = date'2024-02-28' and Sales = row_id and datediff(Ship_Date, Order_Date) between 0 and 6").count() == 400
    assert synth.sales_table(spark, given=ids.limit(0)).count() == 0


def test_given_call_records_keep_their_times(spark):
    start = "timestamp_ntz'2024-02-28 10:00:00'"
    given = spark.range(300).selectExpr("id as row_id", f"{start} as call_start_time", "id * 0.5D as cost", "'sms' as call_type")
    got = synth.cdr_table(spark, 300, 0, given=given)
    assert got.columns == [f.name for f in CALL_RECORD_SCHEMA.fields]
    wrong = f"call_start_time <> {start} or created_at <> {start} or call_type <> 'sms' or message_content is null or call_duration_seconds <> 0"
    assert got.count() == 300 and got.where(wrong).isEmpty()
    assert sorted(r["cost"] for r in got.select("cost").collect()) == [i * 0.5 for i in range(300)]
    drawn = synth.cdr_table(spark, 300, 0).select("id", "subscriber_id", "imsi_number")
    assert sorted(got.select(*drawn.columns).collect()) == sorted(drawn.collect())
    with pytest.raises(ValueError, match="message"):
        synth.cdr_table(spark, 300, 0, given=given.withColumn("message_content", F.lit("x")))
