"""Sales enrichment and filters (FLT-1, FLT-2, FN-3 … FN-5, FN-15, PRJ-2).

Column names are the sales table's (``Order_Date``, ``Sales`` …); they are
matched case-insensitively against the frame, so the same functions run on
the synthetic sales table and on the lower-case sales fact view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.casts import is_float_type


def resolve(df: DataFrame, name: str) -> str:
    """The frame's own spelling of ``name`` (case-insensitive)."""
    lower = name.lower()
    for c in df.columns:
        if c.lower() == lower:
            return c
    raise KeyError(f"column {name!r} not in {df.columns}")


def drop_incomplete(df: DataFrame, columns=("Order_Date", "Sales", "Profit")) -> DataFrame:
    """``dropna(subset=…)``: NULL in any column (or NaN in a float column) drops the row."""
    cols = [resolve(df, c) for c in columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if is_float_type(types[c]):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def enrich_sales(df: DataFrame, max_delay_days: int = 31) -> DataFrame:
    """Shipping delay, calendar parts and profit margin; keeps profitable rows
    shipped within ``max_delay_days`` (no lower bound: negative delays pass)."""
    order_date, ship_date = resolve(df, "Order_Date"), resolve(df, "Ship_Date")
    sales, profit = resolve(df, "Sales"), resolve(df, "Profit")
    with_delay = df.withColumn("shipping_delay", F.date_diff(F.col(ship_date), F.col(order_date)))
    kept = drop_incomplete(with_delay, (order_date, sales, profit)).filter(
        (F.col(profit) > 0) & (F.col("shipping_delay") <= max_delay_days)
    )
    return kept.withColumns(
        {
            "order_year": F.year(order_date),
            "order_month": F.month(order_date),
            "order_day_of_week": F.dayofweek(order_date),
            # Guarded division: 0 when Sales is 0 (or NULL); double result.
            "profit_margin": F.when(
                F.col(sales) != 0, F.col(profit).cast("double") / F.col(sales).cast("double")
            ).otherwise(F.lit(0.0)),
        }
    )
