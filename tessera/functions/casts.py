"""Tolerant casts (FN-6, FN-7, FN-8, PRJ-3).

Spark 4 runs in ANSI mode, where a bad string in ``cast`` fails the whole
job. The load must instead turn unparsable values into NULL (and let the
quality rules drop them), so every cast here is a ``try_cast``. Integers
go through ``double`` first so that decimal strings such as ``'6.55'``
truncate to 6 rather than becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_int(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double").try_cast("int")


def to_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def to_timestamp_ntz(c: Column | str, source: T.DataType | None = None) -> Column:
    """Zone-less timestamp of the session time zone.

    A string with an offset is the instant it names, shown in the session time
    zone; one without is taken as written. A column known to be zone-less
    (``source``) passes through unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(source, T.TimestampNTZType):
        return c
    return c.try_cast("timestamp").try_cast("timestamp_ntz")


# Target type of each call-record column that arrives loosely typed.
CALL_RECORD_CASTS = {
    "call_duration_seconds": to_int,
    "message_length": to_int,
    "signal_strength_dbm": to_int,
    "cost": to_double,
    "call_start_time": to_timestamp_ntz,
    "call_end_time": to_timestamp_ntz,
}


def cast_columns(df: DataFrame, casts: dict) -> DataFrame:
    """Replace each present column by its tolerant cast, in one projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = {
        name: fn(name, types[name]) if fn is to_timestamp_ntz else fn(name)
        for name, fn in casts.items()
        if name in types
    }
    return df.withColumns(present) if present else df


def cast_call_records(df: DataFrame) -> DataFrame:
    return cast_columns(df, CALL_RECORD_CASTS)


def is_float_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))
