"""Tolerant casts never fail a job under ANSI mode."""

import math

from tessera.functions import casts
from tessera.operators.enrich import drop_incomplete


def test_int_cast_rows(spark):
    df = spark.createDataFrame([("1",), (" 7 ",), ("6.55",), ("x",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(casts.to_int("v")).collect()]
    assert got == [1, 7, 6, None, None, None]


def test_double_and_timestamp_casts(spark):
    df = spark.createDataFrame([("2.5", "2024-01-02 03:04:05"), ("n/a", "not a time")], "v string, t string")
    got = df.select(casts.to_double("v").alias("d"), casts.to_timestamp_ntz("t").alias("ts")).collect()
    assert got[0]["d"] == 2.5 and got[1]["d"] is None
    assert str(got[0]["ts"]) == "2024-01-02 03:04:05" and got[1]["ts"] is None
    assert dict(df.select(casts.to_timestamp_ntz("t").alias("ts")).dtypes)["ts"] == "timestamp_ntz"


def test_offsets_name_instants_of_the_session_zone(spark):
    from tests.test_plans import _conf

    df = spark.createDataFrame([("2024-01-01T10:00:00+05:00",), ("2024-01-01 10:00:00",)], "t string")
    for zone, shown in (("UTC", "2024-01-01 05:00:00"), ("America/New_York", "2024-01-01 00:00:00")):
        with _conf(spark, **{"spark.sql.session.timeZone": zone}):
            got = [str(r["ts"]) for r in df.select(casts.to_timestamp_ntz("t").alias("ts")).collect()]
            assert got == [shown, "2024-01-01 10:00:00"]
    # A zone-less column keeps its wall clock, also in an hour that a zone skips.
    with _conf(spark, **{"spark.sql.session.timeZone": "America/New_York"}):
        skipped = spark.sql("select timestamp_ntz '2024-03-10 02:30:00' as call_start_time")
        assert str(casts.cast_call_records(skipped).first()[0]) == "2024-03-10 02:30:00"


def test_cast_call_records_only_touches_present_columns(spark):
    df = spark.createDataFrame([("12", 3.0, "x")], "call_duration_seconds string, cost double, other string")
    out = casts.cast_call_records(df)
    assert dict(out.dtypes) == {"call_duration_seconds": "int", "cost": "double", "other": "string"}


def test_dropna_removes_nan_and_null(spark):
    df = spark.createDataFrame(
        [(1.5, 1.0, "2024-01-01"), (math.nan, 1.0, "2024-01-01"), (None, 1.0, "2024-01-01"), (2.0, 1.0, None)],
        "Sales double, Profit double, Order_Date string",
    )
    assert drop_incomplete(df).count() == 1
