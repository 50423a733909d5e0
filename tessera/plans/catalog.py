"""Query catalogue: each entry pairs a Spark plan over the driver tables with
the same result written as DuckDB SQL over the same tables (the oracle).

Every query reads whole tables; a ``limit`` appears only where it is the
feature (top-k, preview). Every query has an SQL form (``NO_ORACLE`` would list
those without one).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.casts import cast_call_records
from tessera.operators import analytics, enrich, merge, rules
from tessera.plans import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
NO_ORACLE: set[str] = set()


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is None:
            NO_ORACLE.add(name)
        else:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- SQL pieces

F1 = f"f1 as ({fx.SALES_FACT_SQL})"
ENRICHED = (
    F1
    + """,
e0 as (select *, cast(date_diff('day', order_date, ship_date) as integer) as shipping_delay from f1),
enriched as (
 select *, cast(year(order_date) as integer) as order_year, cast(month(order_date) as integer) as order_month,
  cast(dayofweek(order_date) + 1 as integer) as order_day_of_week,
  case when sales <> 0 then cast(profit as double) / cast(sales as double) else 0.0 end as profit_margin
 from e0
 where order_date is not null and sales is not null and profit is not null
   and profit > 0 and shipping_delay <= 31)"""
)

F2 = f"f2 as ({fx.CALL_RECORD_SQL})"
TYPED_SELECT = """select * replace (
  try_cast(trunc(try_cast(call_duration_seconds as double)) as integer) as call_duration_seconds,
  try_cast(cost as double) as cost,
  try_cast(call_start_time as timestamp) as call_start_time,
  try_cast(call_end_time as timestamp) as call_end_time)"""
TYPED = F2 + f",\ntyped as ({TYPED_SELECT} from f2)"

# The gate as SQL, in the same order as rules.CALL_RECORD_RULES.
RULE_SQL = {
    "rule_id": "id is not null and id > 0",
    "rule_call_type": "call_type in ('voice', 'sms', 'data')",
    "rule_service_type": "service_type in ('prepaid', 'postpaid')",
    "rule_direction": "direction in ('incoming', 'outgoing')",
    "rule_network_type": "network_type in ('2G', '3G', '4G', '5G')",
    "rule_network_provider": "network_provider in ('MTN', 'Airtel', 'Glo', '9mobile')",
    "rule_currency": "currency in ('NGN', 'USD')",
    "rule_time_order": "call_end_time >= call_start_time",
    "rule_sim_card_number": r"regexp_matches(sim_card_number, '^8930\d{15}$')",
    "rule_imsi_number": r"regexp_matches(imsi_number, '^\d{15}$')",
    "rule_imei_number": r"regexp_matches(imei_number, '^\d{15}$')",
    "rule_country_code": r"regexp_matches(country_code, '^\+(234|1|44).*$')",
    "rule_cell_tower_id": r"regexp_matches(cell_tower_id, '^CT-\d{4}$')",
    "rule_location_area_code": r"regexp_matches(location_area_code, '^\d{3}-\d{3}$')",
}
ALL_RULES_SQL = " and ".join(f"({p})" for p in RULE_SQL.values())
FIRST_FAILED_SQL = (
    "case "
    + " ".join(f"when not coalesce(({p}), false) then '{n}'" for n, p in RULE_SQL.items())
    + " end"
)

# Other columns of F2 in name order: the deterministic tie-breakers of
# latest-per-id (key and timestamp excluded).
TIE_BREAKERS = sorted(c for c in fx.CALL_RECORD_COLUMNS if c not in ("id", "updated_at"))
LATEST_ORDER_SQL = "updated_at desc nulls last, " + ", ".join(f"{c} asc nulls last" for c in TIE_BREAKERS)


def latest_sql(src: str, order_sql: str = LATEST_ORDER_SQL) -> str:
    return (
        f"select * exclude (_rank) from (select *, row_number() over (partition by id order by "
        f"{order_sql}) as _rank from {src} where id is not null) where _rank = 1"
    )


MERGE_BASE = (
    "with "
    + TYPED
    + f""",
t as (select * from typed where {fx.TARGET_WHERE_SQL}),
b as (select * from f2 where {fx.BATCH_WHERE_SQL}),
changed as (select * from b where updated_at > (select max(updated_at) from t))"""
)


# ---------------------------------------------------------------- sales

# Row-level sales results carry money as double (computed exactly as decimals
# until the end), so both engines hand back the same value type.
MONEY_AS_DOUBLE_SQL = "* replace (cast(sales as double) as sales, cast(profit as double) as profit)"


def _money_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({"sales": F.col("sales").cast("double"), "profit": F.col("profit").cast("double")})


@register("sales_fact", f"with {F1} select {MONEY_AS_DOUBLE_SQL} from f1")
def q_sales_fact(spark, sf_dir):
    return _money_as_double(fx.sales_fact(spark, sf_dir))


@register(
    "sales_drop_nulls",
    f"with {F1} select {MONEY_AS_DOUBLE_SQL} from f1 "
    "where order_date is not null and sales is not null and profit is not null",
)
def q_sales_drop_nulls(spark, sf_dir):
    return _money_as_double(enrich.drop_incomplete(fx.sales_fact(spark, sf_dir)))


@register("sales_enriched", f"with {ENRICHED} select {MONEY_AS_DOUBLE_SQL} from enriched")
def q_sales_enriched(spark, sf_dir):
    return _money_as_double(enrich.enrich_sales(fx.sales_fact(spark, sf_dir)))


def _enriched(spark, sf_dir):
    return enrich.enrich_sales(fx.sales_fact(spark, sf_dir))


@register("latest_order_date", f"with {ENRICHED} select max(order_date) as latest_order_date from enriched")
def q_latest_order_date(spark, sf_dir):
    return analytics.latest_order_date(_enriched(spark, sf_dir))


@register(
    "category_totals",
    f"""with {ENRICHED} select category, cast(sum(profit) as double) as total_profit,
 cast(sum(sales) as double) as total_sales from enriched group by category order by total_profit desc""",
)
def q_category_totals(spark, sf_dir):
    return analytics.category_totals(_enriched(spark, sf_dir))


@register(
    "region_state_totals",
    f"""with {ENRICHED} select region, state, cast(sum(sales) as double) as total_sales,
 cast(sum(profit) as double) as total_profit from enriched group by region, state
 order by region, total_sales desc""",
)
def q_region_state_totals(spark, sf_dir):
    return analytics.region_state_totals(_enriched(spark, sf_dir))


@register(
    "ship_mode_delay",
    f"""with {ENRICHED} select ship_mode, avg(shipping_delay) as avg_shipping_delay
 from enriched group by ship_mode order by avg_shipping_delay""",
)
def q_ship_mode_delay(spark, sf_dir):
    return analytics.ship_mode_delay(_enriched(spark, sf_dir))


@register(
    "top_region_states",
    f"""with {ENRICHED} select region, state, cast(sum(sales) as double) as total_sales,
 cast(sum(profit) as double) as total_profit from enriched group by region, state
 order by region, total_sales desc, state limit 20""",
)
def q_top_region_states(spark, sf_dir):
    return analytics.top_region_states(_enriched(spark, sf_dir), 20)


# ---------------------------------------------------------------- call records

@register("call_records", f"with {F2} select * from f2")
def q_call_records(spark, sf_dir):
    return fx.call_records(spark, sf_dir)


@register("cdr_typed", f"with {TYPED} select * from typed")
def q_cdr_typed(spark, sf_dir):
    return cast_call_records(fx.call_records(spark, sf_dir))


def _typed(spark, sf_dir):
    return cast_call_records(fx.call_records(spark, sf_dir))


def _rule_query(rule_name: str) -> QueryFn:
    def run(spark, sf_dir):
        return _typed(spark, sf_dir).filter(rules.RULES_BY_NAME[rule_name].condition)

    run.__name__ = f"q_{rule_name}"
    return run


for _name, _pred in RULE_SQL.items():
    register(_name, f"with {TYPED} select * from typed where {_pred}")(_rule_query(_name))


@register("cdr_clean", f"with {TYPED} select * from typed where {ALL_RULES_SQL}")
def q_cdr_clean(spark, sf_dir):
    return rules.clean(_typed(spark, sf_dir))


@register(
    "cdr_rejects",
    f"with {TYPED} select *, {FIRST_FAILED_SQL} as failed_rule from typed "
    f"where not coalesce({ALL_RULES_SQL}, false)",
)
def q_cdr_rejects(spark, sf_dir):
    return rules.rejects(_typed(spark, sf_dir))


@register(
    "reject_summary",
    f"with {TYPED} select {FIRST_FAILED_SQL} as failed_rule, count(*) as rows from typed "
    f"where not coalesce({ALL_RULES_SQL}, false) group by 1",
)
def q_reject_summary(spark, sf_dir):
    return rules.reject_summary(_typed(spark, sf_dir))


MASK_SQL = " + ".join(f"case when coalesce(({p}), false) then 0 else {1 << k} end" for k, p in enumerate(RULE_SQL.values()))


@register(
    "reject_masks",
    f"with {TYPED}, m as (select ({MASK_SQL})::bigint as mask from typed) "
    "select mask, count(*) as rows from m where mask <> 0 group by mask",
)
def q_reject_masks(spark, sf_dir):
    """Rejected rows per set of failed rules."""
    return rules.reject_masks(_typed(spark, sf_dir))


@register(
    "reject_causes",
    f"with {TYPED}, m as (select ({MASK_SQL})::bigint as mask from typed) "
    + " union all ".join(
        f"select '{n}' as rule, (count(*) filter (where mask & {1 << k} <> 0))::bigint as n_failed, "
        f"(count(*) filter (where mask = {1 << k}))::bigint as n_only from m"
        for k, n in enumerate(RULE_SQL)
    ),
)
def q_reject_causes(spark, sf_dir):
    """Per rule the rows that fail it, and those that only it rejects."""
    return rules.cause_report(rules.reject_masks(_typed(spark, sf_dir)))


@register(
    "rule_report",
    f"with {TYPED} select count(*) as rows_in, "
    f"count(*) filter (where coalesce({ALL_RULES_SQL}, false)) as rows_clean, "
    + ", ".join(f"count(*) filter (where coalesce({p}, false)) as pass_{n}" for n, p in RULE_SQL.items())
    + " from typed",
)
def q_rule_report(spark, sf_dir):
    return rules.rule_report(_typed(spark, sf_dir))


@register("first_run_load", f"with {TYPED}, gated as (select * from typed where {ALL_RULES_SQL}) {latest_sql('gated')}")
def q_first_run_load(spark, sf_dir):
    return merge.merge_incremental(None, fx.call_records(spark, sf_dir), policy="unique")


@register("watermark", f"{MERGE_BASE} select max(updated_at) as watermark from t")
def q_watermark(spark, sf_dir):
    return merge.watermark(fx.target_records(spark, sf_dir))


@register("changed_rows", f"{MERGE_BASE} select * from changed")
def q_changed_rows(spark, sf_dir):
    return merge.changed_rows(fx.batch_records(spark, sf_dir), fx.target_records(spark, sf_dir))


@register("changed_ids", f"{MERGE_BASE} select distinct id from changed")
def q_changed_ids(spark, sf_dir):
    changed = merge.changed_rows(fx.batch_records(spark, sf_dir), fx.target_records(spark, sf_dir))
    return merge.changed_ids(changed)


@register(
    "unchanged_rows",
    f"{MERGE_BASE} select * from t where not exists (select 1 from changed c where c.id = t.id)",
)
def q_unchanged_rows(spark, sf_dir):
    target = fx.target_records(spark, sf_dir)
    changed = merge.changed_rows(fx.batch_records(spark, sf_dir), target)
    return merge.unchanged_rows(target, changed)


@register(
    "unchanged_rows_bitmap",
    f"{MERGE_BASE} select * from t where not exists (select 1 from changed c where c.id = t.id)",
)
def q_unchanged_rows_bitmap(spark, sf_dir):
    """JOIN-1 with the target cut by the bitmap of changed ids before the exact join."""
    target = fx.target_records(spark, sf_dir)
    changed = merge.changed_rows(fx.batch_records(spark, sf_dir), target)
    return merge.unchanged_rows(target, changed, bitmap=True)


@register(
    "union_by_name",
    f"{MERGE_BASE}, tb as ({TYPED_SELECT} from b) select * from t union all by name select * from tb",
)
def q_union_by_name(spark, sf_dir):
    target = fx.target_records(spark, sf_dir)
    batch = cast_call_records(fx.batch_records(spark, sf_dir))
    return merge.union_by_name(target, batch.select(list(reversed(batch.columns))))


@register(
    "merge_as_coded",
    f"""{MERGE_BASE}, tc as ({TYPED_SELECT} from changed)
select * from t where not exists (select 1 from changed c where c.id = t.id)
union all by name
select * from tc where {ALL_RULES_SQL}""",
)
def q_merge_as_coded(spark, sf_dir):
    return merge.merge_as_coded(fx.target_records(spark, sf_dir), fx.batch_records(spark, sf_dir))


@register(
    "merge_unique",
    "with "
    + TYPED
    + f""",
t0 as (select * from typed where {fx.TARGET_WHERE_SQL}),
t as ({latest_sql('t0')}),
b as (select * from f2 where {fx.BATCH_WHERE_SQL}),
changed as (select * from b where updated_at > (select max(updated_at) from t)),
gated as (select * from ({TYPED_SELECT} from changed) where {ALL_RULES_SQL}),
latest as ({latest_sql('gated')})
select * from t where not exists (select 1 from latest l where l.id = t.id)
union all by name
select * from latest""",
)
def q_merge_unique(spark, sf_dir):
    target = merge.latest_per_key(fx.target_records(spark, sf_dir))
    return merge.merge_unique(target, fx.batch_records(spark, sf_dir))


@register(
    "changed_rows_late",
    f"""{MERGE_BASE}
select * from b where updated_at > (select max(updated_at) from t) - interval 2 day""",
)
def q_changed_rows_late(spark, sf_dir):
    return merge.changed_rows(fx.batch_records(spark, sf_dir), fx.target_records(spark, sf_dir), allowed_lateness="2 days")


PER_KEY_SQL = """changed_pk as (
  select b.* from b left join (select id, max(updated_at) as stored_ts from t group by id) s on b.id = s.id
  where s.stored_ts is null or b.updated_at > s.stored_ts)"""


@register("changed_rows_per_key", f"{MERGE_BASE}, {PER_KEY_SQL} select * from changed_pk")
def q_changed_rows_per_key(spark, sf_dir):
    return merge.changed_rows_per_key(fx.batch_records(spark, sf_dir), fx.target_records(spark, sf_dir))


@register(
    "merge_unique_per_key",
    "with "
    + TYPED
    + f""",
t0 as (select * from typed where {fx.TARGET_WHERE_SQL}),
t as ({latest_sql('t0')}),
b as (select * from f2 where {fx.BATCH_WHERE_SQL}),
{PER_KEY_SQL},
gated as (select * from ({TYPED_SELECT} from changed_pk) where {ALL_RULES_SQL}),
latest as ({latest_sql('gated')})
select * from t where not exists (select 1 from latest l where l.id = t.id)
union all by name
select * from latest""",
)
def q_merge_unique_per_key(spark, sf_dir):
    target = merge.latest_per_key(fx.target_records(spark, sf_dir))
    return merge.merge_unique(target, fx.batch_records(spark, sf_dir), watermark="per_key")


@register("empty_batch_load", f"{MERGE_BASE} select * from t")
def q_empty_batch_load(spark, sf_dir):
    empty = fx.batch_records(spark, sf_dir).filter(F.lit(False))
    return merge.merge_incremental(fx.target_records(spark, sf_dir), empty, policy="as_coded")


@register("latest_per_id", f"with {F2} {latest_sql('f2')}")
def q_latest_per_id(spark, sf_dir):
    return merge.latest_per_key(fx.call_records(spark, sf_dir))


# ---------------------------------------------------------------- sources / sinks

@register("scan_multi_file", "select * from lineitem")
def q_scan_multi_file(spark, sf_dir):
    """lineitem written as two file groups — the second with its key drifted
    to double, as a producer writing nullable integers does — then read back
    as one table of the declared schema."""
    from tessera.sinks.writer import write_new
    from tessera.sources.files import read_files
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    li = read_table(spark, sf_dir, "lineitem")
    root = shared_scratch(spark, "scan_multi_file")
    first = F.coalesce(F.col("l_linenumber") <= 3, F.lit(False))
    write_new(li.filter(first), f"{root}/group_a")
    write_new(li.filter(~first).withColumn("l_orderkey", F.col("l_orderkey").cast("double")), f"{root}/group_b")
    return read_files(spark, [f"{root}/group_a", f"{root}/group_b"], li.schema)


@register("first_load_mixed_types", "select * from lineitem")
def q_first_load_mixed_types(spark, sf_dir):
    """lineitem as one folder whose files disagree on the key's type."""
    from tessera.sources.files import read_files
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    li = read_table(spark, sf_dir, "lineitem")
    path = shared_scratch(spark, "mixed_types")
    odd = F.coalesce(F.col("l_linenumber") % 2 == 1, F.lit(False))
    li.filter(odd).write.parquet(path)
    li.filter(~odd).withColumn("l_orderkey", F.col("l_orderkey").cast("double")).write.mode("append").parquet(path)
    return read_files(spark, [path], li.schema)


@register(
    "first_load_missing_column",
    "select * replace (case when event_id % 2 = 1 then value end as value) from events",
)
def q_first_load_missing_column(spark, sf_dir):
    """events as one folder where only some files have the value column."""
    from tessera.sources.files import read_files
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    events = read_table(spark, sf_dir, "events")
    path = shared_scratch(spark, "missing_column")
    odd = F.coalesce(F.col("event_id") % 2 == 1, F.lit(False))
    events.filter(~odd).drop("value").write.parquet(path)
    events.filter(odd).write.mode("append").parquet(path)
    return read_files(spark, [path], events.schema)


@register("scan_changed_files", "select * from events where event_id % 3 = 0")
def q_scan_changed_files(spark, sf_dir):
    """Only the files written after the cut: a third of the events, beside
    files that hold the rest and are older."""
    from tessera.sources.files import read_changed_files
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    events = read_table(spark, sf_dir, "events")
    path = shared_scratch(spark, "changed_files")
    new = F.coalesce(F.col("event_id") % 3 == 0, F.lit(False))
    events.filter(~new).write.parquet(f"{path}/old")
    _age(spark, f"{path}/old", 30)
    events.filter(new).write.parquet(f"{path}/new")
    return read_changed_files(spark, path, _hours_ago(spark, 24), events.schema)


def _age(spark, path: str, hours: float) -> None:
    """Set the files of a folder back in time, as if they had been written ``hours`` ago."""
    import time

    from tessera.sinks.publish import file_system

    at, fs = file_system(spark, path)
    then = int((time.time() - 3600 * hours) * 1000)
    for status in fs.listStatus(at):
        fs.setTimes(status.getPath(), then, -1)


def _hours_ago(spark, hours: float) -> str:
    from tessera.sources.files import since_hours_ago

    return since_hours_ago(hours, time_zone=spark.conf.get("spark.sql.session.timeZone"))


@register("sized_write", "select * from lineitem")
def q_sized_write(spark, sf_dir):
    """lineitem in files of at most about half a megabyte: bytes a row are measured on one write
    and size the next."""
    from tessera.sinks.writer import bytes_per_row_of, write
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "sized")
    write(read_table(spark, sf_dir, "lineitem"), f"{root}/staged")
    staged = spark.read.parquet(f"{root}/staged")
    write(staged, f"{root}/sized", target_file_bytes=1 << 19, bytes_per_row=bytes_per_row_of(staged))
    return spark.read.parquet(f"{root}/sized")


@register("write_single_file", "select count(*) as rows, 1 as files from part")
def q_write_single_file(spark, sf_dir):
    from tessera.sinks.writer import write
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    path = shared_scratch(spark, "single_file")
    write(read_table(spark, sf_dir, "part").repartition(4), path, single_file=True)
    back = spark.read.parquet(path).select("*", "_metadata.file_path")
    return back.agg(F.count("*").alias("rows"), F.countDistinct("file_path").cast("int").alias("files"))


@register("write_refused", "select count(*) as rows, true as refused from supplier")
def q_write_refused(spark, sf_dir):
    """A create-only write onto an existing table fails and leaves it whole."""
    from pyspark.errors import AnalysisException

    from tessera.sinks.writer import write_new
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    path = shared_scratch(spark, "refused")
    supplier = read_table(spark, sf_dir, "supplier")
    write_new(supplier, path)
    refused = False
    try:
        write_new(supplier.limit(1), path)
    except AnalysisException as e:
        refused = e.getCondition() == "PATH_ALREADY_EXISTS"
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.lit(refused).alias("refused"))


@register("write_read_roundtrip", "select * from orders")
def q_write_read_roundtrip(spark, sf_dir):
    from tessera.sinks.writer import write_new
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    path = shared_scratch(spark, "roundtrip")
    write_new(read_table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@register("publish_roundtrip", "select * from orders")
def q_publish_roundtrip(spark, sf_dir):
    """Publish orders twice (the second run reads the first version and
    writes the next); the live version is the whole table."""
    from tessera.sinks.publish import publish, read_current
    from tessera.sources.tables import read_table
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "publish")
    publish(read_table(spark, sf_dir, "orders"), root)
    publish(read_current(spark, root), root)
    return read_current(spark, root)


@register(
    "range_source",
    """select range as row_id, count(l_orderkey) as lines, round(sum(l_extendedprice), 2) as charged
from range((select max(o_orderkey) + 1 from orders)) left join lineitem on l_orderkey = range group by range""",
)
def q_range_source(spark, sf_dir):
    """Every id of a range over the order keys with what its lines come to (ids without lines included)."""
    from tessera.sources.synth import range_table
    from tessera.sources.tables import read_table

    last = read_table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("k")).first()["k"]
    lines = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("row_id"))
    lines = lines.agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("charged"))
    ids = range_table(spark, 0 if last is None else last + 1)
    return ids.join(lines, "row_id", "left").select("row_id", F.coalesce("lines", F.lit(0)).alias("lines"), "charged")


@register("partition_profile", "select count(*) as rows, true as every_partition_counted from lineitem")
def q_partition_profile(spark, sf_dir):
    from tessera.sinks.writer import partition_profile
    from tessera.sources.tables import read_table

    table = read_table(spark, sf_dir, "lineitem").repartition(5)
    counted = F.count_distinct("partition") == F.count("*")
    return partition_profile(table).agg(F.sum("rows").alias("rows"), counted.alias("every_partition_counted"))


@register("preview_rows", "select least(5, count(*)) as previewed, least(5, count(*)) as found from orders")
def q_preview_rows(spark, sf_dir):
    """The preview's rows, counted, and how many of them are rows of orders."""
    from tessera.sinks.writer import preview
    from tessera.sources.tables import read_table

    orders = read_table(spark, sf_dir, "orders")
    shown = preview(orders, 5).withColumn("shown", F.lit(1))
    found = shown.join(orders.select("o_orderkey").distinct(), "o_orderkey", "left_semi")
    return shown.agg(F.count("*").alias("previewed")).join(found.agg(F.count("*").alias("found")))


# ---------------------------------------------------------------- projections on the given tables

@register(
    "order_calendar",
    """select o_orderkey as order_no, cast(o_orderdate as date) as order_day,
 cast(cast(o_orderdate as date) + cast(o_orderkey % 7 as integer) as date) as due_day from orders""",
)
def q_order_calendar(spark, sf_dir):
    from tessera.operators import projections as pj
    from tessera.sources.tables import read_table

    orders = pj.renamed(read_table(spark, sf_dir, "orders"), {"o_orderkey": "order_no"})
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        "order_no", F.to_date(iso).alias("order_day"), pj.days_after(iso, F.col("order_no") % 7).alias("due_day")
    )


@register(
    "part_labels",
    """select p_partkey as part_no, concat_ws('/', p_brand, case when p_size > 25 then p_type end,
  cast(p_size as varchar)) as label,
 ['East', 'West', 'Central', 'South'][cast(p_partkey % 4 as integer) + 1] as region from part""",
)
def q_part_labels(spark, sf_dir):
    from tessera.operators import projections as pj
    from tessera.sources.tables import read_table

    part = pj.renamed(read_table(spark, sf_dir, "part"), {"p_partkey": "part_no"})
    kind = F.when(F.col("p_size") > 25, F.col("p_type"))
    return part.select(
        "part_no",
        pj.label("/", "p_brand", kind, F.col("p_size").cast("string")).alias("label"),
        pj.pick(["East", "West", "Central", "South"], F.col("part_no") % 4).alias("region"),
    )


@register(
    "line_charges",
    """select l_orderkey, l_linenumber, cast(round(cast(l_extendedprice as decimal(12,2))
 * (1 - cast(l_discount as decimal(4,2))) * (1 + cast(l_tax as decimal(4,2))), 1) as double) as charge from lineitem""",
)
def q_line_charges(spark, sf_dir):
    from tessera.operators import projections as pj
    from tessera.sources.tables import read_table

    rate = lambda c: F.col(c).cast(fx.DEC_RATE)
    charge = F.col("l_extendedprice").cast(fx.DEC_MONEY) * (1 - rate("l_discount")) * (1 + rate("l_tax"))
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", pj.money(charge, 1).cast("double").alias("charge")
    )


# The predicates that a cleaned table must leave empty.
SQL_TEXT_FILTER = "profit <= 0 or shipping_delay > 31"


@register(
    "sales_sql_filter",
    f"with {ENRICHED} select l_orderkey, l_linenumber, state, category, shipping_delay from e0 where {SQL_TEXT_FILTER}",
)
def q_sales_sql_filter(spark, sf_dir):
    """A predicate given as SQL text: the rows of the fact that the enrichment drops (FLT-19)."""
    fact = fx.sales_fact(spark, sf_dir).withColumn("shipping_delay", F.date_diff("ship_date", "order_date"))
    return fact.filter(SQL_TEXT_FILTER).select("l_orderkey", "l_linenumber", "state", "category", "shipping_delay")


@register(
    "double_totals",
    """with s as (select l_returnflag as category,
  cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as sales,
  cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) / 1 as profit from lineitem)
select category, cast(sum(cast(l.profit as decimal(30,4))) as double) as total_profit,
 cast(sum(cast(l.sales as decimal(30,4))) as double) as total_sales from s l group by category""",
)
def q_double_totals(spark, sf_dir):
    """Totals of doubles with four decimals (no rounding before the sum)."""
    from tessera.sources.tables import read_table

    price = F.col("l_extendedprice").cast(fx.DEC_MONEY)
    rows = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("category"),
        (price * (1 - F.col("l_discount").cast(fx.DEC_RATE))).cast("double").alias("sales"),
        (price * F.col("l_tax").cast(fx.DEC_RATE)).cast("double").alias("profit"),
    )
    return analytics.category_totals(rows)


# Call records whose times arrive as text, a third of them with an offset.
TEXT_TIMES_SQL = """select event_id, ts as call_start_time,
 case when event_id % 41 = 0 then null when event_id % 37 = 0 then ts - interval '5' minute else ts + interval '10' minute end as call_end_time
 from events"""


def _text_times(spark, sf_dir):
    from tessera.sources.tables import read_table

    def text(ts):
        local = F.concat((ts + F.expr("interval 5 hours 30 minutes")).cast("string"), F.lit("+05:30"))
        utc = F.concat(ts.cast("string"), F.lit("Z"))
        third = F.col("event_id") % 3
        return F.when(third == 0, local).when(third == 1, utc).otherwise(ts.cast("string"))

    end = F.expr(fx.CALL_RECORD_COLUMNS["call_end_time"])
    return read_table(spark, sf_dir, "events").select(
        "event_id", text(F.col("ts")).alias("call_start_time"), text(end).alias("call_end_time")
    )


@register("cdr_text_times", TEXT_TIMES_SQL)
def q_cdr_text_times(spark, sf_dir):
    return cast_call_records(_text_times(spark, sf_dir))


@register(
    "rule_time_order_text",
    f"select event_id from ({TEXT_TIMES_SQL}) where call_end_time >= call_start_time",
)
def q_rule_time_order_text(spark, sf_dir):
    typed = cast_call_records(_text_times(spark, sf_dir))
    return rules.clean(typed, [rules.RULES_BY_NAME["rule_time_order"]]).select("event_id")


@register(
    "row_metrics",
    f"with {TYPED} select count(*) as rows_in, count(*) filter (where {ALL_RULES_SQL}) as rows_clean from typed",
)
def q_row_metrics(spark, sf_dir):
    """Counts observed while the cleaned table is produced (one pass, no
    separate count jobs), returned as a one-row table."""
    from tessera.sinks.writer import counted

    typed, seen = counted(_typed(spark, sf_dir), "rows_in")
    cleaned, kept = counted(rules.clean(typed), "rows_clean")
    cleaned.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(int(seen.get["rows"]), int(kept.get["rows"]))], "rows_in bigint, rows_clean bigint"
    )


# ---------------------------------------------------------------- synthetic tables

SEED = 42


def mix32_sql(x: str) -> str:
    """The 32-bit mix of ``tessera.functions.uniform`` in DuckDB SQL."""
    from tessera.functions.uniform import MASK32, MIX_MULTIPLIER as M

    s1 = f"xor({x}, (({x}) >> 16))"
    s2 = f"((({s1}) * {M}) & {MASK32})"
    s3 = f"xor({s2}, ({s2} >> 16))"
    s4 = f"((({s3}) * {M}) & {MASK32})"
    return f"xor({s4}, ({s4} >> 16))"


def keyed_sql(stream: str, key: str = "row_id", seed: int = SEED) -> str:
    from tessera.functions.uniform import MASK32, MIX_MULTIPLIER as M, stream_constant

    return (
        f"xor(xor((({key}) & {MASK32}), {stream_constant(seed, stream)}), "
        f"(((({key}) >> 32) * {M}) & {MASK32}))"
    )


def uniform_sql(stream: str, key: str = "row_id", seed: int = SEED) -> str:
    return f"({mix32_sql(keyed_sql(stream, key, seed))} / 4294967296.0)"


def _sales_synth_sql() -> str:
    """The sales generator in DuckDB SQL. Spark's ``round`` never returns
    negative zero while DuckDB's does for tiny negative values; ``+ 0.0``
    turns -0.0 into 0.0 so both hand back the same double."""
    from tessera.sources import synth as S

    def u(name):
        return uniform_sql(f"sales.{name}")

    def idx(name, n):
        return f"cast(floor({u(name)} * {n}) as integer)"

    def choice(name, values):
        lst = ", ".join(f"'{v}'" for v in values)
        return f"[{lst}][{idx(name, len(values))} + 1]"

    return f"""with d as (select o_orderkey as row_id, cast(o_orderdate as date) as Order_Date, o_totalprice from orders)
select row_id, Order_Date,
 Order_Date + {idx('ship_date', S.SHIP_DAYS)} as Ship_Date,
 {choice('ship_mode', S.SHIP_MODES)} as Ship_Mode,
 cast({S.POSTAL_CODE_BASE} + {idx('postal_code', S.POSTAL_CODES)} as varchar) as Postal_Code,
 {choice('region', S.REGIONS)} as Region,
 concat_ws('-', 'PRD', row_id) as Product_Reference,
 {choice('category', S.CATEGORIES)} as Category,
 {choice('sub_category', S.SUB_CATEGORIES)} as Sub_Category,
 o_totalprice as Sales,
 {idx('quantity', 10)} + 1 as Quantity,
 round({u('profit')} * 500 - 100, 2) + 0.0 as Profit,
 {choice('state', S.STATES)} as State
from d"""


@register("sales_synth", _sales_synth_sql())
def q_sales_synth(spark, sf_dir):
    """The orders completed to the sales table: keys, dates and totals as given, the rest drawn by key."""
    from tessera.sources.synth import sales_table
    from tessera.sources.tables import read_table

    orders = read_table(spark, sf_dir, "orders")
    given = orders.selectExpr("o_orderkey as row_id", "o_orderdate as Order_Date", "o_totalprice as Sales")
    return sales_table(spark, seed=SEED, given=given)


@register(
    "sales_synth_report",
    f"""with s as ({_sales_synth_sql()}),
e as (select *, cast(date_diff('day', Order_Date, Ship_Date) as integer) as shipping_delay from s
      where Order_Date is not null and Sales is not null and not isnan(Sales)
        and Profit is not null and not isnan(Profit))
select Region, State, cast(sum(cast(Sales as decimal(20,2))) as double) as total_sales,
 cast(sum(cast(Profit as decimal(20,2))) as double) as total_profit
from e where Profit > 0 and shipping_delay <= 31 group by Region, State""",
)
def q_sales_synth_report(spark, sf_dir):
    """The sales job end to end on the completed orders."""
    return analytics.region_state_totals(enrich.enrich_sales(q_sales_synth(spark, sf_dir)))


CDR_DIRTY_PERCENT = 40


def _cdr_synth_sql() -> str:
    from tessera.sources import synth as S

    def u(name):
        return uniform_sql(f"cdr.{name}")

    def idx(name, n):
        return f"cast(floor({u(name)} * {n}) as integer)"

    def choice(name, values):
        lst = ", ".join(f"'{v}'" for v in values)
        return f"[{lst}][{idx(name, len(values))} + 1]"

    def digits(name, width):
        h, l = width - width // 2, width // 2
        return (
            f"lpad(cast(cast(floor({u(name + '.hi')} * {10**h}) as bigint) as varchar), {h}, '0') || "
            f"lpad(cast(cast(floor({u(name + '.lo')} * {10**l}) as bigint) as varchar), {l}, '0')"
        )

    def pool(stream, index_sql, part):
        return uniform_sql(f"{stream}.{part}", f"cast({index_sql} as bigint)")

    def err(col):
        return uniform_sql(f"cdr_error.{col}")

    from tessera.functions.uniform import MASK32, SALT_MULTIPLIER

    word = mix32_sql(f"xor(text_key, ((j * {SALT_MULTIPLIER}) & {MASK32}))")
    n_alpha = len(S.MESSAGE_ALPHABET)

    def char(half):
        return f"substr('{S.MESSAGE_ALPHABET}', cast(floor(({half}) * {n_alpha} / 65536.0) as integer) + 1, 1)"

    text = (
        f"substr(array_to_string(list_transform(range(0, (msg_len + 1) // 2), lambda j: "
        f"{char(f'({word}) >> 16')} || {char(f'({word}) & 65535')}), ''), 1, msg_len)"
    )
    clean = {
        "id": f"cast({idx('id', S.MAX_ID)} + 1 as double)",
        "subscriber_id": "concat_ws('-', substr(sh, 1, 8), substr(sh, 9, 4), substr(sh, 13, 4), substr(sh, 17, 4), substr(sh, 21, 12))",
        "sim_card_number": "'8930' || " + digits("sim", 15),
        "imsi_number": digits("imsi", 15),
        "imei_number": digits("imei", 15),
        "service_type": choice("service_type", S.SERVICE_TYPES),
        "direction": choice("direction", S.DIRECTIONS),
        "roaming_status": f"{u('roaming')} < 0.5",
        "caller_number": "'234' || " + digits("caller", 10),
        "receiver_number": "'234' || " + digits("receiver", 10),
        "country_code": "'+234'",
        "cell_tower_id": f"'CT-' || lpad(cast(cast(floor({pool('tower', idx('tower', S.CELL_TOWER_POOL), 0)} * 10000) as bigint) as varchar), 4, '0')",
        "location_latitude": f"{u('lat')} * 10 + 4.0",
        "location_longitude": f"{u('lon')} * 13 + 2.0",
        "location_area_code": (
            f"lpad(cast(cast(floor({pool('area', idx('area', S.AREA_CODE_POOL), 0)} * 1000) as bigint) as varchar), 3, '0') || '-' || "
            f"lpad(cast(cast(floor({pool('area', idx('area', S.AREA_CODE_POOL), 1)} * 1000) as bigint) as varchar), 3, '0')"
        ),
        "region": f"'Region ' || lpad(cast({idx('region', S.REGION_POOL)} + 1 as varchar), 3, '0')",
        "city": f"'City ' || lpad(cast({idx('city', S.CITY_POOL)} + 1 as varchar), 3, '0')",
        "network_type": choice("network_type", S.NETWORK_TYPES),
        "network_provider": choice("provider", S.NETWORK_PROVIDERS),
        "signal_strength_dbm": f"cast({idx('dbm', 71)} - 120 as double)",
        "cost": "value",
        "currency": choice("currency", S.CURRENCIES),
        "call_type": "call_type",
        "call_start_time": "start_ts",
        "call_end_time": "end_ts",
        "created_at": "start_ts",
        "updated_at": "end_ts",
        "call_duration_seconds": "cast(case when call_type = 'voice' then duration else 0 end as double)",
        "message_content": f"case when call_type = 'voice' then null else {text} end",
        "message_length": "cast(case when call_type = 'voice' then 0 else msg_len end as double)",
    }

    def damaged(col, value):
        out = f"case when {err(col)} < {S.ERROR_RATE} then null "
        if col in S.PHONE_COLUMNS:
            out += f"when {err(col)} < {2 * S.ERROR_RATE} then 'ERROR' || right({value}, 4) "
        elif col == "call_duration_seconds":
            out += f"when {err(col)} < {2 * S.ERROR_RATE} then -abs({value}) "
        return out + f"else {value} end"

    types = {f.name: f.dataType.simpleString() for f in S.CALL_RECORD_SCHEMA.fields}
    duck = {"double": "double", "string": "varchar", "boolean": "boolean", "timestamp_ntz": "timestamp"}
    cols = ",\n ".join(
        f"cast(case when dirty then {damaged(c, v)} else {v} end as {duck[types[c]]}) as {c}"
        for c, v in clean.items()
    )
    return f"""with n as (select count(*) as n from events),
p as (select n,
  (select min(range) from range(1000003, 1002003, 2) where gcd(range, n) = 1) as a,
  {SEED} % n as b,
  cast(floor(n * {CDR_DIRTY_PERCENT / 100}) as bigint) as n_dirty from n),
r as (select event_id as row_id, ts, value from events),
b as (select row_id, value,
  ((row_id * (select a from p) + (select b from p)) % (select n from p)) < (select n_dirty from p) as dirty,
  {choice('call_type', S.CALL_TYPES)} as call_type,
  {idx('duration', S.MAX_DURATION_SECONDS)} + 1 as duration,
  {idx('message_length', S.MAX_MESSAGE_LENGTH)} + 1 as msg_len,
  md5(concat_ws('|', '{SEED}', 'subscriber', cast(row_id as varchar))) as sh,
  {keyed_sql('message')} as text_key,
  cast(ts as timestamp) as start_ts
 from r),
c as (select *, start_ts + to_seconds(duration) as end_ts from b)
select {cols}
from c"""


@register("cdr_synth", _cdr_synth_sql())
def q_cdr_synth(spark, sf_dir):
    """The events completed to call records, 40 % dirty: times and costs as given, the rest drawn by id."""
    from tessera.sources.synth import cdr_table
    from tessera.sources.tables import read_table

    events = read_table(spark, sf_dir, "events")
    given = events.selectExpr("event_id as row_id", "ts as call_start_time", "value as cost")
    return cdr_table(spark, events.count(), CDR_DIRTY_PERCENT, SEED, given=given)


@register(
    "cdr_synth_load",
    f"""with s as ({_cdr_synth_sql()}),
typed as (select * replace (
  try_cast(trunc(call_duration_seconds) as integer) as call_duration_seconds,
  try_cast(trunc(message_length) as integer) as message_length,
  try_cast(trunc(signal_strength_dbm) as integer) as signal_strength_dbm)
 from s)
select * from typed where {ALL_RULES_SQL}""",
)
def q_cdr_synth_load(spark, sf_dir):
    """First-run load (as coded) of the completed events."""
    return rules.clean(cast_call_records(q_cdr_synth(spark, sf_dir)))


# ---------------------------------------------------------------- streaming load

def _stored_call_records_sql() -> str:
    """F2 as the producer stores it: the declared 30-column schema, columns
    F2 lacks as NULL, numbers as double (what ``files.conform`` produces)."""
    from tessera.schemas import CALL_RECORD_SCHEMA

    duck = {"double": "double", "string": "varchar", "boolean": "boolean", "timestamp_ntz": "timestamp"}
    cols = []
    for f in CALL_RECORD_SCHEMA.fields:
        t = duck[f.dataType.simpleString()]
        cols.append(f"try_cast({f.name} as {t}) as {f.name}" if f.name in fx.CALL_RECORD_COLUMNS else f"cast(null as {t}) as {f.name}")
    return "select " + ", ".join(cols) + " from f2"


def _stored_latest_order() -> str:
    from tessera.schemas import CALL_RECORD_SCHEMA

    others = sorted(f.name for f in CALL_RECORD_SCHEMA.fields if f.name not in ("id", "updated_at"))
    return "updated_at desc nulls last, " + ", ".join(f"{c} asc nulls last" for c in others)


STORED_TYPED_SELECT = """select * replace (
  try_cast(trunc(call_duration_seconds) as integer) as call_duration_seconds,
  try_cast(trunc(message_length) as integer) as message_length,
  try_cast(trunc(signal_strength_dbm) as integer) as signal_strength_dbm)"""


INCREMENTAL_LOAD_SQL = f"""with {F2},
src as ({_stored_call_records_sql()}),
day1 as (select * from src where {fx.TARGET_WHERE_SQL}),
day2 as (select * from src where {fx.BATCH_WHERE_SQL}),
gated1 as (select * from ({STORED_TYPED_SELECT} from day1) where {ALL_RULES_SQL}),
v1 as ({latest_sql('gated1', _stored_latest_order())}),
changed2 as (select * from day2 where updated_at > (select max(updated_at) from v1)),
gated2 as (select * from ({STORED_TYPED_SELECT} from changed2) where {ALL_RULES_SQL}),
latest2 as ({latest_sql('gated2', _stored_latest_order())})
select * from v1 where not exists (select 1 from latest2 l where l.id = v1.id)
union all by name
select * from latest2"""


def _day_files(spark, sf_dir):
    """T's and B's call records as two days of stored files."""
    from tessera.schemas import CALL_RECORD_SCHEMA
    from tessera.sources.files import conform

    records = fx.call_records(spark, sf_dir)
    day1 = records.filter(F.col("updated_at") < F.lit(fx.TARGET_BEFORE).cast("timestamp_ntz"))
    day2 = records.filter(F.col("updated_at") >= F.lit(fx.BATCH_FROM).cast("timestamp_ntz"))
    return conform(day1, CALL_RECORD_SCHEMA), conform(day2, CALL_RECORD_SCHEMA)


@register("batch_incremental_load", INCREMENTAL_LOAD_SQL)
def q_batch_incremental_load(spark, sf_dir):
    """Two runs of the batch load: the first run reads day one's files; the
    second reads only the files modified after a point between the two drops
    (day two's) and merges them; the second version is returned."""
    from tessera.plans.jobs import run_load
    from tessera.sinks.publish import read_current
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "batch_load")
    source, target = f"{root}/source", f"{root}/target"
    day1, day2 = _day_files(spark, sf_dir)
    day1.write.parquet(f"{source}/day1")
    _age(spark, f"{source}/day1", 30)
    run_load(spark, source, target)
    day2.write.parquet(f"{source}/day2")
    run_load(spark, source, target, since=_hours_ago(spark, 24))
    return read_current(spark, target)


@register("relisted_load", INCREMENTAL_LOAD_SQL)
def q_relisted_load(spark, sf_dir):
    """The second run lists the files of both days; day one's are left out by their footers."""
    from tessera.plans.jobs import run_load
    from tessera.sinks.publish import read_current
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "relisted_load")
    source, target = f"{root}/source", f"{root}/target"
    day1, day2 = _day_files(spark, sf_dir)
    day1.write.parquet(f"{source}/day1")
    run_load(spark, source, target)
    day2.write.parquet(f"{source}/day2")
    run_load(spark, source, target, since=_hours_ago(spark, 24), target_file_bytes=1 << 20)
    return read_current(spark, target)


@register("bucketed_load", INCREMENTAL_LOAD_SQL)
def q_bucketed_load(spark, sf_dir):
    """The two runs on a target in buckets of the id; the second rewrites only
    the buckets its ids fall into and starts at the recorded listing."""
    from tessera.plans.jobs import run_load
    from tessera.sinks.publish import read_current
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "bucketed_load")
    source, target = f"{root}/source", f"{root}/target"
    day1, day2 = _day_files(spark, sf_dir)
    day1.write.parquet(f"{source}/day1")
    run_load(spark, source, target, buckets=8)
    day2.write.parquet(f"{source}/day2")
    run_load(spark, source, target)
    return read_current(spark, target)


@register("stream_incremental_load", INCREMENTAL_LOAD_SQL)
def q_stream_incremental_load(spark, sf_dir):
    """Two scheduled runs of the streaming load. Day one's files (T's
    records) give the first version; day two's files (B's records) are the
    only new files on the second run and are merged into the second
    version, which is returned."""
    from tessera.sinks.publish import read_current
    from tessera.streaming.incremental import start_incremental_load
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "stream_load")
    source, target, checkpoint = f"{root}/source", f"{root}/target", f"{root}/checkpoint"
    day1, day2 = _day_files(spark, sf_dir)
    day1.write.parquet(f"{source}/day1")
    start_incremental_load(spark, f"{source}/*", target, checkpoint).awaitTermination()
    day2.write.parquet(f"{source}/day2")
    start_incremental_load(spark, f"{source}/*", target, checkpoint).awaitTermination()
    return read_current(spark, target)


@register("stream_new_checkpoint", INCREMENTAL_LOAD_SQL)
def q_stream_new_checkpoint(spark, sf_dir):
    """Day two arrives through a second stream with a checkpoint of its own,
    whose first micro-batch has the number the first stream's had."""
    from tessera.sinks.publish import read_current
    from tessera.streaming.incremental import start_incremental_load
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "stream_second")
    target = f"{root}/target"
    for name, day in zip(("one", "two"), _day_files(spark, sf_dir)):
        day.write.parquet(f"{root}/{name}/day")
        start_incremental_load(spark, f"{root}/{name}/*", target, f"{root}/checkpoint_{name}").awaitTermination()
    return read_current(spark, target)


@register("stream_drifting_types", INCREMENTAL_LOAD_SQL)
def q_stream_drifting_types(spark, sf_dir):
    """The streaming load over file names: half of each day's files hold the duration as
    text, which a stream of rows with one declared schema can't read."""
    from tessera.sinks.publish import read_current
    from tessera.streaming.incremental import start_incremental_load
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "stream_drifting")
    source, target, checkpoint = f"{root}/source", f"{root}/target", f"{root}/checkpoint"
    for name, day in zip(("day1", "day2"), _day_files(spark, sf_dir)):
        odd = F.coalesce(F.pmod("id", F.lit(2)) == 1, F.lit(False))
        day.where(~odd).write.parquet(f"{source}/{name}a")
        drifted = day.where(odd).withColumn("call_duration_seconds", F.col("call_duration_seconds").cast("string"))
        drifted.write.parquet(f"{source}/{name}b")
        start_incremental_load(spark, f"{source}/*", target, checkpoint, by_file=True).awaitTermination()
    return read_current(spark, target)


@register("stream_latest_versions", ORACLES["merge_unique_per_key"])
def q_stream_latest_versions(spark, sf_dir):
    """The latest version of every id as a stream's state: T's records, then B's that pass the rules."""
    from tessera.streaming.incremental import latest_versions, start_latest_versions
    from tessera.util import shared_scratch

    root = shared_scratch(spark, "stream_versions")
    first = fx.target_records(spark, sf_dir)
    second = rules.clean(cast_call_records(fx.batch_records(spark, sf_dir))).select(first.columns)
    for arrived, rows in ((1, first), (2, second)):
        rows.withColumn("arrived", F.lit(arrived)).write.parquet(f"{root}/source/{arrived}")
        schema = spark.read.parquet(f"{root}/source/1").schema
        stream = spark.readStream.schema(schema).parquet(f"{root}/source/*")
        start_latest_versions(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return latest_versions(spark, f"{root}/out")
