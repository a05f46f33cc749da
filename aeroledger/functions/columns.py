"""Small column expressions shared by the reports and features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Risk levels in report order.
RISK_ORDER = ["low", "medium", "high"]


def day(value: str | dt.date) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value.replace(hour=0, minute=0, second=0, microsecond=0)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.strptime(value, "%Y-%m-%d")


def ntz(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_of(time: str) -> str:
    """Name of the day column that a table laid out by ``time`` has."""
    return f"{time}_day"


def from_day(df: DataFrame, column: str, start) -> DataFrame:
    """Rows of ``start`` or later; a table laid out by day reads only such days."""
    df = df.filter(F.col(column) >= ntz(day(start)))
    return df.filter(F.col(day_of(column)) >= F.lit(day(start).date())) if day_of(column) in df.columns else df


def until(df: DataFrame, column: str, end: dt.datetime, included: bool = False) -> DataFrame:
    """Rows before ``end``, or up to it; a table laid out by day reads only days that may have such."""
    df = df.filter(F.col(column) <= ntz(end) if included else F.col(column) < ntz(end))
    last = end.date() if included or end.time() != dt.time() else end.date() - dt.timedelta(days=1)
    return df.filter(F.col(day_of(column)) <= F.lit(last)) if day_of(column) in df.columns else df


def between_days(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Keep whole calendar days ``start`` to ``end``, both included.

    The bounds stay on the bare column, so they reach the Parquet scan, and on the
    day column of a table that is laid out by day, so that other days are not opened.
    """
    if start is not None:
        df = from_day(df, column, start)
    if end is not None:
        df = until(df, column, day(end) + dt.timedelta(days=1))
    return df


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / whole, places)


def risk_rank(column: str) -> Column:
    rank = F.lit(None).cast("int")
    for i, level in reversed(list(enumerate(RISK_ORDER, start=1))):
        rank = F.when(F.col(column) == level, i).otherwise(rank)
    return rank


def minutes_between(later: str, earlier: str) -> Column:
    """Signed difference in minutes as a double."""
    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)
