"""Seeded synthetic tables (SRC-3, SRC-4, SRC-11, FN-21 … FN-33).

Both generators are one lazy plan over ``spark.range``: every column is a
pure function of (seed, row id), so a table is identical under any partition
count and any re-execution of a lost partition, and nothing runs on the
driver. The sales table follows the reference's 13 columns; the call-record
table follows its 30 columns, with a chosen share of dirty rows (NULL cells,
corrupted phone numbers, negative durations).

Both also complete a given table: ``given`` rows have a long ``row_id`` and any of the
table's columns, which are kept; the other columns are drawn by ``row_id``.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.uniform import StagedUniforms, Uniforms, keyed, mix32, salted, with_hash_columns
from tessera.schemas import CALL_RECORD_SCHEMA, SALES_SCHEMA

ROWS_PER_PARTITION = 2_000_000
_observation_ids = itertools.count(1)


def _observed(df: DataFrame, table: str) -> DataFrame:
    """Count the generated rows as the table is produced (a named observed
    metric, no extra pass). The observation is also a plan boundary: a filter
    on generated columns then reads the computed values instead of inlining
    every hash expression into the predicate, which would recompute each hash
    several times in one oversized generated method."""
    return df.observe(f"{table}_rows_{next(_observation_ids)}", F.count(F.lit(1)).alias("rows"))

# The sales table's categorical columns.
SHIP_MODES = ["First Class", "Second Class", "Standard Class", "Same Day"]
REGIONS = ["East", "West", "Central", "South"]
CATEGORIES = ["Furniture", "Office Supplies", "Technology"]
SUB_CATEGORIES = ["Chairs", "Tables", "Binders", "Phones", "Accessories"]
STATES = ["California", "Texas", "New York", "Florida", "Illinois", "Washington"]
FIRST_ORDER_DATE = "2022-01-01"
ORDER_DAYS = 1000
SHIP_DAYS = 7
POSTAL_CODE_BASE, POSTAL_CODES = 90000, 100  # 90000 … 90099



def range_table(spark: SparkSession, n: int, name: str = "row_id") -> DataFrame:
    """``range(n)`` with the id column renamed (SRC-3, PRJ-1), split so each
    partition holds about ``ROWS_PER_PARTITION`` rows."""
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_PARTITION))
    return spark.range(0, n, 1, parts).withColumnRenamed("id", name)


def sales_table(
    spark: SparkSession, n_records: int = 100_000_000, seed: int = 42, given: DataFrame | None = None
) -> DataFrame:
    """The synthetic sales table (SRC-4): ``n_records`` rows, or the ``given`` ones completed."""
    rid = F.col("row_id")
    u = Uniforms(seed, "sales", rid)
    base = range_table(spark, n_records) if given is None else given
    kept = {} if given is None else {f.name.lower(): F.col(f.name).cast(f.dataType) for f in SALES_SCHEMA.fields}
    kept = {c: kept[c] for c in map(str.lower, base.columns) if c in kept}
    order_date = F.date_add(F.to_date(F.lit(FIRST_ORDER_DATE)), u.index("order_date", ORDER_DAYS))
    order_date = kept.get("order_date", order_date)
    drawn = {
        "Order_Date": order_date,
        "Ship_Date": F.date_add(order_date, u.index("ship_date", SHIP_DAYS)),
        "Ship_Mode": u.choice("ship_mode", SHIP_MODES),
        "Postal_Code": (F.lit(POSTAL_CODE_BASE) + u.index("postal_code", POSTAL_CODES)).cast("string"),
        "Region": u.choice("region", REGIONS),
        "Product_Reference": F.concat_ws("-", F.lit("PRD"), rid),
        "Category": u.choice("category", CATEGORIES),
        "Sub_Category": u.choice("sub_category", SUB_CATEGORIES),
        "Sales": F.round(u["sales"] * 1000, 2),
        "Quantity": u.index("quantity", 10) + 1,
        "Profit": F.round(u["profit"] * 500 - 100, 2),
        "State": u.choice("state", STATES),
    }
    table = base.select(rid, *[kept.get(c.lower(), value).alias(c) for c, value in drawn.items()])
    return _observed(table, "sales_table")


# The call-record producer's value lists and rates.
CALL_TYPES = ["voice", "sms"]
DIRECTIONS = ["incoming", "outgoing"]
NETWORK_TYPES = ["2G", "3G", "4G", "5G"]
CURRENCIES = ["USD", "NGN"]
NETWORK_PROVIDERS = ["MTN", "Airtel", "Glo", "9mobile"]
SERVICE_TYPES = ["prepaid", "postpaid"]
ERROR_RATE = 0.05
MESSAGE_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz ,."
MAX_ID = 9_999_999
MAX_MESSAGE_LENGTH = 160
MAX_DAYS_AGO = 112
MAX_DURATION_SECONDS = 3600
# Pools drawn once per table (sizes as in the producer); their members are
# generated by rule from the pool index.
CELL_TOWER_POOL, AREA_CODE_POOL, REGION_POOL, CITY_POOL = 500, 300, 100, 200
DEFAULT_ANCHOR = "2025-01-01 00:00:00"

# The uniforms one call record draws (digit strings take two each).
CDR_DRAWS = [
    "id", "sim.hi", "sim.lo", "imsi.hi", "imsi.lo", "imei.hi", "imei.lo",
    "service_type", "direction", "roaming", "caller.hi", "caller.lo",
    "receiver.hi", "receiver.lo", "tower", "lat", "lon", "area", "region",
    "city", "network_type", "provider", "dbm", "cost", "currency", "call_type",
    "days", "hours", "minutes", "seconds", "duration", "message_length",
]
# Columns in the producer's order; each cell of a dirty row is damaged with
# its own uniform.
CDR_COLUMNS = [f.name for f in CALL_RECORD_SCHEMA.fields]
PHONE_COLUMNS = ("caller_number", "receiver_number")


def scatter_multiplier(n: int) -> int:
    """A multiplier coprime to ``n`` so that ``(a·i + b) mod n`` permutes
    [0, n): the dirty rows are spread over all partitions without a sort."""
    a = 1_000_003
    while math.gcd(a, n) != 1:
        a += 2
    return a


def _message_text(text_key: Column, length: Column) -> Column:
    """Random text of ``length`` characters (NULL when ``length`` is NULL).

    Chunk ``j`` of the text is the mix of the row's ``text_key`` salted by
    ``j``; its high and low 16 bits pick two characters (uniform to within
    0.1 %). Each nested ``transform`` binds one intermediate to a lambda
    variable, so nothing is evaluated twice. Lambda functions run outside
    generated code, so the caller keeps this in a projection of its own."""
    n = len(MESSAGE_ALPHABET)
    alphabet = F.lit(MESSAGE_ALPHABET)
    chunks = F.sequence(F.lit(0), F.floor((length - 1) / 2).cast("int"))
    words = F.transform(F.transform(chunks, lambda j: salted(text_key, j)), mix32)

    def char(half: Column) -> Column:
        return F.substring(alphabet, F.floor(half * n / 65536.0).cast("int") + 1, 1)

    pairs = F.transform(words, lambda h: F.concat(char(F.shiftright(h, 16)), char(h.bitwiseAND(F.lit(0xFFFF)))))
    return F.substring(F.array_join(pairs, ""), 1, length)


def cdr_table(
    spark: SparkSession,
    total_records: int = 1_000_000,
    dirty_percentage: float = 20,
    seed: int = 42,
    anchor: str = DEFAULT_ANCHOR,
    given: DataFrame | None = None,
) -> DataFrame:
    """The call-record table (SRC-11) with exactly ``floor(n·p/100)`` dirty rows.

    ``given`` rows are completed instead (``total_records`` is then the number of row ids
    that the dirty share is dealt over; it is exact for ids 0 … n-1). Times follow their
    ``call_start_time`` where they have one. Timestamps count back from ``anchor`` (a fixed parameter, so a table can be
    regenerated exactly), and are written as zone-less microseconds."""
    n = total_records
    n_dirty = int(total_records * (dirty_percentage / 100))
    rid = F.col("row_id")
    a = scatter_multiplier(max(n, 1))
    b = seed % max(n, 1)

    # Every hash word is a column (staged projections keep the plan small).
    u = StagedUniforms(seed, "cdr", "row_id", CDR_DRAWS, "_u")
    err = StagedUniforms(seed, "cdr_error", "row_id", CDR_COLUMNS, "_e")
    kept = {f.name for f in CALL_RECORD_SCHEMA.fields} & set(() if given is None else given.columns)
    base = (range_table(spark, n) if given is None else given).withColumn(
        "_dirty", F.pmod(rid * F.lit(a) + F.lit(b), F.lit(n)) < F.lit(n_dirty)
    )
    drawn = with_hash_columns(base, {**u.words(), **err.words()})
    # Pool members are drawn by pool index: a second round of hash words.
    pools = {
        "tower0": StagedUniforms(seed, "tower", "_tower_index", ["0"], "_pt"),
        "area0": StagedUniforms(seed, "area", "_area_index", ["0"], "_pa0_"),
        "area1": StagedUniforms(seed, "area", "_area_index", ["1"], "_pa1_"),
    }
    drawn = drawn.withColumns(
        {"_tower_index": u.index("tower", CELL_TOWER_POOL), "_area_index": u.index("area", AREA_CODE_POOL)}
    )
    drawn = with_hash_columns(drawn, {k: v for p in pools.values() for k, v in p.words().items()})
    tower = pools["tower0"]["0"]
    area = [pools["area0"]["0"], pools["area1"]["1"]]

    call_type = F.col("call_type") if "call_type" in kept else u.choice("call_type", CALL_TYPES)
    offset = (
        u.index("days", MAX_DAYS_AGO + 1) * 86400
        + u.index("hours", 24) * 3600
        + u.index("minutes", 60) * 60
        + u.index("seconds", 60)
    )
    duration = u.index("duration", MAX_DURATION_SECONDS) + 1
    start = F.lit(anchor).cast("timestamp_ntz") - F.make_dt_interval(secs=offset)
    if "call_start_time" in kept:
        start = F.col("call_start_time").cast("timestamp_ntz")
    end = start + F.make_dt_interval(secs=duration)
    msg_len = u.index("message_length", MAX_MESSAGE_LENGTH) + 1
    is_voice = call_type == F.lit("voice")
    sub_hex = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("subscriber"), rid.cast("string")))

    clean = {
        "id": (u.index("id", MAX_ID) + 1).cast("double"),
        "subscriber_id": F.concat_ws(
            "-", *[F.substring(sub_hex, p, w) for p, w in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        ),
        "sim_card_number": F.concat(F.lit("8930"), u.digits("sim", 15)),
        "imsi_number": u.digits("imsi", 15),
        "imei_number": u.digits("imei", 15),
        "service_type": u.choice("service_type", SERVICE_TYPES),
        "direction": u.choice("direction", DIRECTIONS),
        "roaming_status": u["roaming"] < 0.5,
        "caller_number": F.concat(F.lit("234"), u.digits("caller", 10)),
        "receiver_number": F.concat(F.lit("234"), u.digits("receiver", 10)),
        "country_code": F.lit("+234"),
        "cell_tower_id": F.concat(
            F.lit("CT-"), F.lpad(F.floor(tower * 10000).cast("bigint").cast("string"), 4, "0")
        ),
        "location_latitude": u["lat"] * 10 + 4.0,
        "location_longitude": u["lon"] * 13 + 2.0,
        "location_area_code": F.concat(
            F.lpad(F.floor(area[0] * 1000).cast("bigint").cast("string"), 3, "0"),
            F.lit("-"),
            F.lpad(F.floor(area[1] * 1000).cast("bigint").cast("string"), 3, "0"),
        ),
        "region": F.concat(F.lit("Region "), F.lpad((u.index("region", REGION_POOL) + 1).cast("string"), 3, "0")),
        "city": F.concat(F.lit("City "), F.lpad((u.index("city", CITY_POOL) + 1).cast("string"), 3, "0")),
        "network_type": u.choice("network_type", NETWORK_TYPES),
        "network_provider": u.choice("provider", NETWORK_PROVIDERS),
        "signal_strength_dbm": (u.index("dbm", 71) - 120).cast("double"),
        "cost": F.round(u["cost"] * 9.99 + 0.01, 2),
        "currency": u.choice("currency", CURRENCIES),
        "call_type": call_type,
        "call_start_time": start,
        "call_end_time": end,
        "created_at": start,
        "updated_at": end,
        "call_duration_seconds": F.when(is_voice, duration).otherwise(0).cast("double"),
        "_text_length": F.when(~is_voice, msg_len),
        "_text_key": keyed(seed, "message", rid),
        "message_length": F.when(is_voice, 0).otherwise(msg_len).cast("double"),
    }

    clean |= {c: F.col(c) for c in kept - {"message_content"}}

    def damaged(name: str, value: Column) -> Column:
        r = err[name]
        out = F.when(r < ERROR_RATE, F.lit(None))
        if name in PHONE_COLUMNS:
            out = out.when(r < 2 * ERROR_RATE, F.concat(F.lit("ERROR"), F.substring(value, -4, 4)))
        elif name == "call_duration_seconds":
            out = out.when(r < 2 * ERROR_RATE, -F.abs(value))
        return out.otherwise(value)

    # Then three projections: clean values from the hash columns (generated
    # code), the message text (lambda functions, interpreted), and the damage
    # of dirty rows (generated code). Each step refers to a costly value of
    # the step below more than once, so the optimizer keeps them apart.
    generated = drawn.select(rid, "_dirty", *[err.column_of[c] for c in CDR_COLUMNS], *[clean[c].alias(c) for c in clean])
    if "message_content" in kept:
        raise ValueError("message texts are drawn, not given")
    with_text = generated.withColumn("message_content", _message_text(F.col("_text_key"), F.col("_text_length")))
    cols = [
        F.when(F.col("_dirty"), damaged(f.name, F.col(f.name))).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in CALL_RECORD_SCHEMA.fields
    ]
    return _observed(with_text.select(*cols), "cdr_table")
