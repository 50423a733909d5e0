"""Sales aggregations, sorts and top-k (AGG-1, AGG-3 … AGG-5, SRT-1 … SRT-3, LIM-2).

Each function returns a DataFrame; printing is the caller's business. Every
grouping is a hash aggregation with a partial (map-side) step, so a group
holding a third of all rows is reduced to one row per input partition before
the shuffle. Money is summed exactly at its own scale and cast to double only at
the end, so totals do not depend on partitioning; values that no decimal of the
chosen scale holds exactly make their group a plain double sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.casts import is_float_type
from tessera.operators.enrich import resolve

# Doubles that stand for at most nine decimals are summed exactly: a double sum
# depends on the order rows meet in (and so on partitioning), an exact one does not.
# Most are whole numbers of billionths below 2^53, which are added up as two bigints,
# thousandths and the billionths left over; larger ones as decimals of this type.
EXACT = "decimal(38,9)"
BILLION, UNIT, MOST = 10**9, 10**6, 9.0e6


def _parts(df: DataFrame, name: str) -> dict[str, Column]:
    """Aggregates that the total of a money column is made of.

    Decimals need one exact sum. Doubles need the sums of thousandths and
    billionths, the exact sum of the values too large for those, how many values
    there are beyond ``EXACT``, and the plain sum for the groups that have any
    (infinities, NaN, more than nine decimals)."""
    col_name = resolve(df, name)
    value, key = F.col(col_name), name.lower()
    if not is_float_type(df.schema[col_name].dataType):
        return {f"_{key}_exact": F.sum(value)}
    near = F.abs(value) < MOST
    tiny = F.rint(F.when(near, value) * float(BILLION))
    small = F.coalesce(tiny / float(BILLION) == value, F.lit(False))
    whole = F.when(small, tiny).cast("bigint")
    exact = F.when(~small, value).try_cast(EXACT)
    held = small | F.coalesce(exact.cast("double") == value, F.lit(False))
    return {
        f"_{key}_high": F.try_sum(F.call_function("div", whole, F.lit(UNIT).cast("bigint"))),
        f"_{key}_low": F.try_sum(whole % UNIT),
        f"_{key}_exact": F.try_sum(F.when(held, exact)),
        f"_{key}_small": F.count_if(small),
        f"_{key}_other": F.count_if(value.isNotNull() & ~held),
        f"_{key}_plain": F.sum(value),
    }


SUFFIXES = ("_high", "_low", "_exact", "_small", "_other", "_plain")


def _total(columns: list[str], name: str, alias: str) -> Column:
    """The total of a money column from its parts (of one group)."""
    key = name.lower()
    exact = F.col(f"_{key}_exact")
    if f"_{key}_plain" not in columns:
        return exact.cast("double").alias(alias)
    plain = F.col(f"_{key}_plain")
    # Both sums are NULL without a small value, one is if it has left a bigint's range.
    lost = (F.col(f"_{key}_small") > 0) & (F.col(f"_{key}_high").isNull() | F.col(f"_{key}_low").isNull())
    unit = F.lit(1).cast("decimal(18,0)")
    tiny = (F.col(f"_{key}_high") * F.lit(UNIT).cast("decimal(7,0)") + F.col(f"_{key}_low") * unit).cast("decimal(29,0)")
    small = (tiny * F.lit("0.000000001").cast("decimal(9,9)")).cast(EXACT)
    both = F.coalesce(F.try_add(F.coalesce(small, F.lit(0).cast(EXACT)), F.coalesce(exact, F.lit(0).cast(EXACT))).cast("double"), plain)
    return F.when(plain.isNull() | lost | (F.col(f"_{key}_other") != 0), plain).otherwise(both).alias(alias)


def _totals(df: DataFrame, keys: list[str], *wanted: tuple[str, str]) -> DataFrame:
    """(keys, alias of each wanted money column's total)."""
    parts = {k: c for name, _ in wanted for k, c in _parts(df, name).items()}
    summed = df.groupBy(*keys).agg(*[c.alias(k) for k, c in parts.items()])
    return summed.select(*keys, *[_total(summed.columns, name, alias) for name, alias in wanted])


def latest_order_date(df: DataFrame) -> DataFrame:
    return df.agg(F.max(resolve(df, "Order_Date")).alias("latest_order_date"))


def category_totals(df: DataFrame) -> DataFrame:
    totals = _totals(df, [resolve(df, "Category")], ("Profit", "total_profit"), ("Sales", "total_sales"))
    return totals.orderBy(F.col("total_profit").desc())


def region_state_totals(df: DataFrame) -> DataFrame:
    region, state = resolve(df, "Region"), resolve(df, "State")
    totals = _totals(df, [region, state], ("Sales", "total_sales"), ("Profit", "total_profit"))
    return totals.orderBy(F.col(region), F.col("total_sales").desc())


def ship_mode_delay(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(resolve(df, "Ship_Mode"))
        .agg(F.avg("shipping_delay").alias("avg_shipping_delay"))
        .orderBy("avg_shipping_delay")
    )


def top_region_states(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` region/state groups in report order; the state name is
    a unique tie-breaker, so the cut is deterministic. Planned as
    ``TakeOrderedAndProject`` (a per-partition top-n, then a merge)."""
    region, state = resolve(df, "Region"), resolve(df, "State")
    totals = _totals(df, [region, state], ("Sales", "total_sales"), ("Profit", "total_profit"))
    return totals.orderBy(F.col(region), F.col("total_sales").desc(), F.col(state)).limit(n)


def sales_summary(df: DataFrame) -> DataFrame:
    """The finest grouping the four reports need, in one pass: exact money
    sums, the delay sum and count, and the latest order date per
    (category, region, state, ship mode)."""
    keys = [resolve(df, k) for k in ("Category", "Region", "State", "Ship_Mode")]
    money = {**_parts(df, "Profit"), **_parts(df, "Sales")}
    return df.groupBy(*keys).agg(
        *[c.alias(k) for k, c in money.items()],
        F.sum(F.col("shipping_delay").cast("bigint")).alias("_delay_sum"),
        F.count("shipping_delay").alias("_delay_count"),
        F.max(resolve(df, "Order_Date")).alias("_latest"),
    )


def sales_report(df: DataFrame) -> dict[str, DataFrame]:
    """All four analytics of the sales job from one pass over ``df``.

    The summary (at most categories × regions × states × ship modes rows) is
    checkpointed to the shared checkpoint folder, so the four reports re-read
    that small table instead of re-scanning (or regenerating) the input four
    times. Exact sums re-add exactly and the average is sum / count, so each
    report equals its one-pass function above."""
    from tessera.util import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    summary = sales_summary(df).checkpoint(eager=True)
    category, region, state, ship_mode = (
        resolve(df, "Category"), resolve(df, "Region"), resolve(df, "State"), resolve(df, "Ship_Mode"),
    )

    parts = [c for c in summary.columns if c.endswith(SUFFIXES)]

    def totals(*keys):
        summed = summary.groupBy(*keys).agg(*[F.try_sum(c).alias(c) for c in parts])
        wanted = (("Profit", "total_profit"), ("Sales", "total_sales"))
        return summed.select(*keys, *[_total(summed.columns, name, alias) for name, alias in wanted])

    return {
        "latest_order_date": summary.agg(F.max("_latest").alias("latest_order_date")),
        "category_totals": totals(category).orderBy(F.col("total_profit").desc()),
        "region_state_totals": totals(region, state)
        .select(region, state, "total_sales", "total_profit")
        .orderBy(F.col(region), F.col("total_sales").desc()),
        "ship_mode_delay": summary.groupBy(ship_mode)
        .agg((F.sum("_delay_sum").cast("double") / F.sum("_delay_count")).alias("avg_shipping_delay"))
        .orderBy("avg_shipping_delay"),
    }
