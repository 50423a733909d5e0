"""Every catalogue query against its DuckDB oracle on the same tables."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import digest
from tests.conftest import SMALL_SF

from tessera.plans import catalog

ORACLES, QUERIES = catalog.ORACLES, catalog.QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and not catalog.NO_ORACLE
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["region", "state", "total_sales", "total_profit"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SMALL_SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.execute(ORACLES[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


@pytest.mark.parametrize(
    "name,order",
    [
        ("category_totals", "total_profit desc, category"),
        ("region_state_totals", "region, total_sales desc, state"),
        ("ship_mode_delay", "avg_shipping_delay, ship_mode"),
    ],
)
def test_reports_come_in_order(spark, duck, name, order):
    """The row order too, with the group's name as tie-breaker on both sides."""
    from pyspark.sql import functions as F

    sdf = QUERIES[name](spark, SMALL_SF)
    rows = [tuple(r) for r in sdf.collect()]
    want = duck.execute(f"select {', '.join(sdf.columns)} from ({ORACLES[name]}) order by {order}").fetchall()
    tied = spark.createDataFrame(rows, sdf.schema).orderBy(*[F.expr(x.removesuffix(" desc")).desc() if x.endswith(" desc") else F.expr(x) for x in order.split(", ")])
    key = sdf.columns.index(order.split(" desc")[0].split(", ")[0])
    assert [r[key] for r in rows] == [r[key] for r in want]
    assert [tuple(r)[:2] for r in tied.collect()] == [r[:2] for r in want]


def test_every_oracle_has_rows():
    """At the scale of the comparison no result is empty, so that equal means something."""
    import duckdb

    from tessera.sources.tables import TABLES, table_path
    from tests.conftest import ORACLE_SF

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(ORACLE_SF, t)}')")
    empty = [name for name, sql in ORACLES.items() if not con.execute(f"select count(*) from ({sql})").fetchone()[0]]
    assert empty == []
