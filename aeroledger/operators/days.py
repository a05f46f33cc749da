"""Tables laid out by day, so that a range of days reads only its own files.

The partition column carries the name of the time it comes from (``observation_time`` is laid out by
``observation_time_day``). ``between_days`` adds a condition on it to the one on the time, and Spark then prunes the
folders of all other days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.columns import day_of


def with_day(table: DataFrame, time: str) -> DataFrame:
    return table.withColumn(day_of(time), F.to_date(time))


def _write(table: DataFrame, root: str, time: str, mode: str = "overwrite", **options) -> None:
    """A folder per day; a day larger than a task's share is split, small days share a task."""
    day = day_of(time)
    rows = table if day in table.columns else with_day(table, time)
    rows.hint("rebalance", F.col(day)).write.mode(mode).options(**options).partitionBy(day).parquet(root)


def write_days(table: DataFrame, root: str, time: str) -> None:
    """Store a table by the day of ``time``; rows without a time share a folder of their own."""
    _write(table, root, time)


def append_days(table: DataFrame, root: str, time: str) -> None:
    """Add rows to their days."""
    _write(table, root, time, mode="append")


def replace_days(table: DataFrame, root: str, time: str) -> None:
    """Replace the days that ``table`` has rows of; all other days keep their files."""
    _write(table, root, time, partitionOverwriteMode="dynamic")


def read_days(spark: SparkSession, root: str, schema: StructType, time: str) -> DataFrame:
    """The stored table with its day as the last column; ``schema`` is that of the rows."""
    day = day_of(time)
    plain = [f for f in schema.fields if f.name != day]
    return spark.read.schema(StructType([*plain, StructField(day, DateType())])).parquet(root)


def days_of(table: DataFrame, time: str) -> list[dt.date | None]:
    """The days that a batch touches, null among them; a row per day reaches the driver."""
    return [r[0] for r in table.select(F.to_date(time)).distinct().collect()]


def of_days(table: DataFrame, time: str, days: list[dt.date | None]) -> DataFrame:
    """The rows of these days, from their folders alone."""
    day = F.col(day_of(time))
    known = [d for d in days if d is not None]
    return table.where(day.isin(known) | day.isNull() if None in days else day.isin(known))
