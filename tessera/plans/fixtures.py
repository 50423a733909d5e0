"""Fixture views over the driver tables.

F1 is the sales fact (the shape the sales analytics consume), F2 the call
records (the shape the incremental load consumes); T and B split F2 into a
target and an overlapping batch. Each view is a DataFrame plan built from
the driver tables, so its size grows with them; the SQL texts next to them
are the same views for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.casts import cast_call_records
from tessera.sources.tables import read_table
from tessera.util import bounded_broadcast

# Boundaries of the target / batch split of F2 (they overlap for five days).
TARGET_BEFORE = "2024-01-20 00:00:00"
BATCH_FROM = "2024-01-15 00:00:00"

DEC_MONEY = "decimal(12,2)"
DEC_RATE = "decimal(4,2)"
DEC_PROFIT = "decimal(18,4)"


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part.

    Join order is dimension-first: nation and region, each proven small by
    a bounded count, are broadcast into customer (no shuffle of customer),
    the result meets orders on the customer key, then lineitem on the order
    key, then part. At scale lineitem is shuffled twice (order key, part key) and
    nothing large is broadcast; adaptive execution may still switch a join to
    broadcast when its runtime size turns out small.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")

    # Each dimension's size is proven by a bounded count of its own scan.
    nation_b = bounded_broadcast(nation)
    region_b = bounded_broadcast(region)
    cust_geo = (
        customer.join(nation_b, customer.c_nationkey == nation_b.n_nationkey)
        .join(region_b, nation_b.n_regionkey == region_b.r_regionkey)
        .select("c_custkey", "n_name", "r_name")
    )
    order_geo = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey).select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "n_name", "r_name"
    )
    joined = li.join(order_geo, li.l_orderkey == order_geo.o_orderkey).join(
        part, F.col("l_partkey") == part.p_partkey
    )

    price = F.col("l_extendedprice").cast(DEC_MONEY)
    margin = F.col("l_discount").cast(DEC_RATE) - F.col("l_tax").cast(DEC_RATE)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_suppkey") % 5 == 0), F.lit(None).cast("date"))
        .otherwise(F.col("l_shipdate").cast("date"))
        .alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("l_suppkey").alias("postal_code"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.concat(F.lit("PRD-"), F.col("l_partkey").cast("string")).alias("product_reference"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_suppkey") % 50 == 1, F.lit(0).cast(DEC_MONEY)).otherwise(price).alias("sales"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast(DEC_PROFIT))
        .otherwise((price * margin).cast(DEC_PROFIT))
        .alias("profit"),
    )


SALES_FACT_SQL = """
select l_orderkey, l_linenumber, cast(o_orderdate as date) as order_date,
 case when l_linenumber = 7 and l_suppkey % 5 = 0 then null else cast(l_shipdate as date) end as ship_date,
 o_orderpriority as ship_mode, l_suppkey as postal_code, r_name as region, n_name as state,
 p_type as category, p_brand as sub_category,
 concat('PRD-', cast(l_partkey as varchar)) as product_reference, cast(l_quantity as integer) as quantity,
 case when l_suppkey % 50 = 1 then cast(0 as decimal(12,2)) else cast(l_extendedprice as decimal(12,2)) end as sales,
 case when l_discount = 0 then null
      else cast(cast(l_extendedprice as decimal(12,2)) * (cast(l_discount as decimal(4,2)) - cast(l_tax as decimal(4,2))) as decimal(18,4)) end as profit
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
 join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey
"""


# the mapping from events to call-record columns. Fixed values that
# shape the fixture: which event ids become null / repeated ids, and which
# rows break which quality rule.
CALL_RECORD_COLUMNS = {
    "id": "case when event_id%97=0 then null when event_id%3=0 then event_id else event_id%2500 end",
    "updated_at": "ts",
    "call_type": "case event_type when 'click' then 'voice' when 'view' then 'sms' when 'purchase' then 'data' when 'signup' then 'fax' end",
    "service_type": "case when user_id%10=0 then 'trial' when user_id%2=0 then 'prepaid' else 'postpaid' end",
    "direction": "case when event_id%29=0 then 'sideways' when event_id%2=0 then 'incoming' else 'outgoing' end",
    "network_type": "case event_id%5 when 0 then '2G' when 1 then '3G' when 2 then '4G' when 3 then '5G' else case when event_id%25=4 then '6G' else '4G' end end",
    "network_provider": "case user_id%5 when 0 then 'MTN' when 1 then 'Airtel' when 2 then 'Glo' when 3 then '9mobile' else case when event_id%3=0 then 'Other' else 'MTN' end end",
    "currency": "case when event_id%23=0 then 'EUR' when event_id%2=0 then 'NGN' else 'USD' end",
    "sim_card_number": "concat('8930', lpad(cast(event_id*7919 as string), case when event_id%11=0 then 14 else 15 end, '0'))",
    "imsi_number": "lpad(cast(event_id*104729 as string), case when event_id%13=0 then 16 else 15 end, '0')",
    "imei_number": "case when event_id%17=0 then 'x' else lpad(cast(event_id*1299709 as string), 15, '0') end",
    "country_code": "case event_id%4 when 0 then '+234' when 1 then '+1' when 2 then '+44' else case when event_id%12=3 then '+33' else '+2348' end end",
    "cell_tower_id": "concat(case when event_id%19=0 then 'ct-' else 'CT-' end, lpad(cast(event_id%10000 as string),4,'0'))",
    "location_area_code": "concat(lpad(cast(event_id%1000 as string),3,'0'), case when event_id%31=0 then '/' else '-' end, lpad(cast(user_id%1000 as string),3,'0'))",
    "call_duration_seconds": "case when event_id%7=0 then 'n/a' else cast(event_id%3600 as string) end",
    "call_start_time": "ts",
    "call_end_time": "case when event_id%41=0 then null when event_id%37=0 then ts - interval '5' minute else ts + interval '10' minute end",
    "cost": "value",
}

CALL_RECORD_SQL = "select " + ",\n ".join(
    f"{expr.replace('as string', 'as varchar')} as {name}" for name, expr in CALL_RECORD_COLUMNS.items()
) + "\nfrom events"


def call_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw call records as they arrive (strings not yet typed)."""
    events = read_table(spark, sf_dir, "events")
    return events.select([F.expr(e).alias(n) for n, e in CALL_RECORD_COLUMNS.items()])


def _before(ts: str) -> Column:
    return F.col("updated_at") < F.lit(ts).cast("timestamp_ntz")


def target_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: the already published target — typed, as every published target is."""
    return cast_call_records(call_records(spark, sf_dir).filter(_before(TARGET_BEFORE)))


def batch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B: the incoming raw batch, overlapping T for five days."""
    return call_records(spark, sf_dir).filter(~_before(BATCH_FROM))


TARGET_WHERE_SQL = f"updated_at < timestamp '{TARGET_BEFORE}'"
BATCH_WHERE_SQL = f"updated_at >= timestamp '{BATCH_FROM}'"
