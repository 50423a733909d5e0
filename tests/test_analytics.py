"""Exact money totals."""

import math

from pyspark.sql import functions as F

from tessera.operators import analytics


def _sales(spark, rows):
    df = spark.createDataFrame(rows, "Category string, Sales double, Profit double")
    return df.withColumns({"Region": F.lit("r"), "State": F.col("Category"), "Ship_Mode": F.lit("m"),
                           "shipping_delay": F.lit(1), "Order_Date": F.current_date()})


def test_small_values_add_up_exactly(spark):
    df = _sales(spark, [("a", 0.004, 0.004)] * 1000)
    assert analytics.category_totals(df).first()["total_profit"] == 4.0
    report = analytics.sales_report(df)
    assert report["category_totals"].first()["total_profit"] == 4.0
    assert report["region_state_totals"].first()["total_sales"] == 4.0


def test_values_beyond_the_decimal_are_summed_as_doubles(spark):
    df = _sales(spark, [("a", math.inf, 1e-12), ("a", 1.0, 1e-12), ("b", 1e35, 0.5), ("b", 1.0, None), ("c", None, None)])
    for frame in (analytics.category_totals(df), analytics.sales_report(df)["category_totals"]):
        got = {r["Category"]: r for r in frame.collect()}
        assert got["a"]["total_sales"] == math.inf and got["a"]["total_profit"] == 2e-12
        assert got["b"]["total_sales"] == 1e35 and got["b"]["total_profit"] == 0.5
        assert got["c"]["total_sales"] is None
