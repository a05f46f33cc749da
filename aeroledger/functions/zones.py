"""Local time and UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import sized_broadcast


def utc_to_local(utc: Column, zone: Column) -> Column:
    """Wall-clock time in ``zone``; null without a zone."""
    return F.from_utc_timestamp(utc.cast("timestamp"), zone).cast("timestamp_ntz")


def local_to_utc(local: Column, zone: Column) -> Column:
    """UTC of a wall-clock time.

    A time that occurs twice, when clocks go back, means the later one (standard
    time); Spark alone would take the earlier. Clocks go back by one hour, in a
    few zones by half an hour.
    """
    first = F.to_utc_timestamp(local.cast("timestamp"), zone)
    answer = first
    for shift in ("30 minutes", "1 hour"):
        later = first + F.expr(f"interval {shift}")
        answer = F.when(F.from_utc_timestamp(later, zone) == local.cast("timestamp"), later).otherwise(answer)
    return answer.cast("timestamp_ntz")


def zone_lookup(airports: DataFrame, airport: str, zone: str) -> DataFrame:
    """(airport, zone) pairs, one per code, small enough to broadcast if counted so."""
    pairs = (
        airports.select(F.col("iata_code").alias(airport), F.nullif(F.trim("timezone"), F.lit("")).alias(zone))
        .filter(F.col(airport).isNotNull())
        .groupBy(airport).agg(F.max(zone).alias(zone))
    )
    return sized_broadcast(pairs)


def with_zone(df: DataFrame, airports: DataFrame, airport: str, zone: str) -> DataFrame:
    return df.join(zone_lookup(airports, airport, zone), airport, "left")


def board_time(date: Column, time: Column) -> Column:
    """Wall-clock time of a board's date and HH:MM; null if either is unusable."""
    usable = date.rlike(r"^\d{4}-\d\d?-\d\d?$") & time.rlike(r"^\d\d?:\d\d?$")
    return F.when(usable, F.concat_ws(" ", date, time)).try_cast("timestamp_ntz")


def board_times_to_utc(
    df: DataFrame, airports: DataFrame, date: str, times: dict[str, str], airport: str
) -> DataFrame:
    """UTC of board times given as {output column: HH:MM column}; one zone lookup for all."""
    placed = with_zone(df, airports, airport, "zone")
    return placed.withColumns({
        out: local_to_utc(board_time(F.col(date), F.col(time)), F.col("zone")) for out, time in times.items()
    }).drop("zone")


def expected_board_hour(airports: DataFrame, now: Column, offset_hours: int = 1) -> DataFrame:
    """Which board to expect per airport at ``now`` (UTC).

    Before half past, the offset is one hour less. The hour is counted on the
    airport's clock; the zone offset is the one in force at ``now``.
    """
    local = utc_to_local(now, F.col("timezone"))
    hours = F.when(F.minute(now) < 30, offset_hours - 1).otherwise(offset_hours)
    target = F.date_trunc("hour", local).cast("timestamp_ntz") + F.make_dt_interval(hours=hours)
    seconds = ((F.unix_micros(local.cast("timestamp")) - F.unix_micros(now.cast("timestamp"))) / 1_000_000).cast("int")
    of_day = F.pmod(seconds, F.lit(86400))
    clock = F.concat(
        (of_day / 3600).cast("int").cast("string"), F.lit(":"),
        F.lpad(((of_day % 3600) / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
        F.lpad((of_day % 60).cast("string"), 2, "0"),
    )
    return airports.filter("timezone is not null and timezone <> ''").select(
        "iata_code",
        F.col("timezone").alias("airport_timezone"),
        F.date_format(target, "yyyy-MM-dd").alias("board_date"),
        F.date_format(target, "HH").alias("shift"),
        F.date_format(target, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        F.when(seconds < 0, F.concat(F.lit("-1 day, "), clock)).otherwise(clock).alias("utc_offset"),
    )
