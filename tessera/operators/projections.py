"""Small projections of the reports (PRJ-1, PRJ-5, FN-1, FN-2, FN-9 … FN-11, FN-13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns under new names; the others keep theirs (PRJ-1)."""
    return df.withColumnsRenamed(dict(names))


def pick(values: Sequence, index: Column) -> Column:
    """The ``index``-th (from 0) of a literal list (PRJ-5, FN-10, FN-11)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def label(separator: str, *columns: str | Column) -> Column:
    """Columns joined as text, NULLs left out (FN-9)."""
    return F.concat_ws(separator, *columns)


def days_after(day: str | Column, days: Column) -> Column:
    """The date ``days`` after a date, timestamp or ISO text (FN-1, FN-2)."""
    return F.date_add(F.to_date(day), days.cast("int"))


def money(value: Column, digits: int = 2) -> Column:
    """Rounded half away from zero, exactly: a decimal all the way (FN-13)."""
    return F.round(value.cast("decimal(30,9)"), digits)
