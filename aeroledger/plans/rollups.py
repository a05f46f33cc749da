"""Stored day states of the flight and weather reports.

A state row holds counts, sums and minima of one day and hour (flights, per airline) or one day (weather, per
station), which any selection of days adds up. States are laid out by day; new or corrected rows replace the states of
the days they touch, computed from those days alone, so a replayed batch changes nothing. Reports then read as many
rows as days, not as flights, and give what ``reports`` gives.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from ..functions.columns import count_if, day, day_of, percent
from ..operators import days
from . import reports
from .reports import OBSERVED, SCHEDULED, VISIBILITY_BANDS, WIND_BANDS, band

# Delay thresholds that the flight states count; other ones need states of their own.
THRESHOLDS = (10, 15)
FLIGHT_KEYS = [day_of(SCHEDULED), "hour", "airline_code"]
WEATHER_KEYS = [day_of(OBSERVED), "station_id"]
# Means that the weather states can give, and the columns that must all be known in a row.
MEANS = {"vis": (["visibility_statute_mi"], ["visibility_statute_mi"]), "temp": (["temp_c", "dewpoint_c"],) * 2}
BANDS = {"vis": ("visibility_statute_mi", VISIBILITY_BANDS), "wind": ("wind_speed_kt", WIND_BANDS)}


# ---- states ------------------------------------------------------------------------

def flight_states(flights: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """Per day, hour and airline: flights, scored ones, and per threshold late ones and the cells of the confusion table."""
    said, scored = F.col("delay_prob") > 0.5, F.col("delay_prob").isNotNull()
    counts = [F.count(F.lit(1)).alias("flights"), count_if(scored).alias("scored")]
    for limit in thresholds:
        late = F.col("delay_min") >= limit
        counts += [
            count_if(late).alias(f"late_{limit}"), F.sum(F.when(late, F.col("delay_min"))).cast("long").alias(f"late_minutes_{limit}"),
            count_if(said & late).alias(f"tp_{limit}"), count_if(~said & ~late).alias(f"tn_{limit}"),
            count_if(said & ~late).alias(f"fp_{limit}"), count_if(~said & late).alias(f"fn_{limit}"),
        ]
    keys = [F.to_date(SCHEDULED).alias(FLIGHT_KEYS[0]), F.hour(SCHEDULED).alias("hour"), "airline_code"]
    return flights.groupBy(*keys).agg(*counts)


def weather_states(metar: DataFrame) -> DataFrame:
    """Per day and station: sums and counts for the means, and count and least value of every band."""
    values = []
    for name, (columns, known) in MEANS.items():
        seen = F.lit(True)
        for column in known:
            seen = seen & F.col(column).isNotNull()
        values.append(count_if(seen).alias(f"{name}_seen"))
        values += [F.sum(F.when(seen, F.col(c))).alias(f"{name}_sum_{c}") for c in columns]
    for name, (column, bands) in BANDS.items():
        for place, (label, _) in enumerate(bands):
            here = F.col(column).isNotNull() & (band(column, bands) == label)
            values += [count_if(here).alias(f"{name}_n_{place}"), F.min(F.when(here, F.col(column))).alias(f"{name}_min_{place}")]
    return metar.groupBy(F.to_date(OBSERVED).alias(WEATHER_KEYS[0]), "station_id").agg(*values)


def store(states: DataFrame, root: str, time: str) -> StructType:
    """Write all states by day; the schema with which ``read`` finds them again."""
    days.write_days(states, root, time)
    return states.schema


def refresh(table: DataFrame, root: str, time: str, touched: list[dt.date | None], states_of) -> None:
    """Compute the states of the touched days anew from ``table``, which is laid out by day, and replace those alone."""
    if touched:
        days.replace_days(states_of(days.of_days(table, time, touched)), root, time)


def read(spark: SparkSession, root: str, schema: StructType, time: str) -> DataFrame:
    return days.read_days(spark, root, schema, time)


def _days(states: DataFrame, name: str, date_start, date_end) -> DataFrame:
    if date_start is not None:
        states = states.filter(F.col(name) >= F.lit(day(date_start).date()))
    if date_end is not None:
        states = states.filter(F.col(name) <= F.lit(day(date_end).date()))
    return states


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


# ---- flights -----------------------------------------------------------------------

def _flights(states: DataFrame, limit: int, date_start, date_end) -> DataFrame:
    if f"late_{limit}" not in states.columns:
        raise ValueError(f"the stored states have no delay threshold {limit}; build them with it")
    return _days(states, FLIGHT_KEYS[0], date_start, date_end)


def flight_stats(states: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    n = delay_threshold
    total, late, scored = _total("flights"), _total(f"late_{n}"), _total("scored")
    return _flights(states, n, date_start, date_end).agg(
        total.alias("total_flights"), late.alias("delayed_flights"),
        percent(late, F.nullif(total, F.lit(0))).alias("delay_rate"),
        F.coalesce(F.round(F.sum(f"late_minutes_{n}") / F.nullif(late, F.lit(0)), 2), F.lit(0.0)).alias("avg_delay"),
        scored.alias("flights_with_ml"),
        F.coalesce(percent(_total(f"tp_{n}") + _total(f"tn_{n}"), F.nullif(scored, F.lit(0))), F.lit(0.0)).alias("ml_accuracy"),
        F.min(FLIGHT_KEYS[0]).alias("date_min"), F.max(FLIGHT_KEYS[0]).alias("date_max"),
    )


def _rate(limit: int) -> Column:
    return percent(F.sum(f"late_{limit}"), F.sum("flights"))


def daily_stats(states: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    rows = _flights(states, delay_threshold, date_start, date_end)
    return rows.groupBy(F.col(FLIGHT_KEYS[0]).alias("date")).agg(
        F.sum("flights").alias("total"), F.sum(f"late_{delay_threshold}").alias("delayed"), _rate(delay_threshold).alias("delay_rate")
    ).orderBy("date")


def hourly_stats(states: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    rows = _flights(states, delay_threshold, date_start, date_end)
    return rows.groupBy("hour").agg(F.sum("flights").alias("flights"), _rate(delay_threshold).alias("delay_rate")).orderBy("hour")


def airline_stats(
    states: DataFrame, airlines: DataFrame, delay_threshold: int = 10, top: int = 15, date_start=None, date_end=None
) -> DataFrame:
    rows = _flights(states, delay_threshold, date_start, date_end).filter(F.col("airline_code").isNotNull())
    busiest = rows.groupBy(F.col("airline_code").alias("airline")).agg(
        F.sum("flights").alias("flights"), _rate(delay_threshold).alias("delay_rate")
    )
    return reports.named_airlines(busiest.orderBy(F.desc("flights"), "airline").limit(top), airlines)


def confusion(states: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    rows = _flights(states, delay_threshold, date_start, date_end)
    return reports.confusion_shares(rows.agg(*[_total(f"{c}_{delay_threshold}").alias(c) for c in ("tp", "tn", "fp", "fn")]))


# ---- weather -----------------------------------------------------------------------

def _weather(states: DataFrame, date_start, date_end, station) -> DataFrame:
    rows = _days(states, WEATHER_KEYS[0], date_start, date_end)
    return rows.filter(F.col("station_id") == station) if station else rows


def _bins(states: DataFrame, name: str, label: str, low: str) -> DataFrame:
    bands = BANDS[name][1]
    one = states.agg(*[f(f"{name}_{part}_{n}").alias(f"{part}_{n}") for n in range(len(bands)) for part, f in (("n", F.sum), ("min", F.min))])
    each = F.array(*[
        F.struct(F.lit(text).alias(label), F.col(f"n_{n}").alias("count"), F.col(f"min_{n}").alias(low)) for n, (text, _) in enumerate(bands)
    ])
    return one.select(F.inline(each)).filter("count > 0").orderBy(low)


def visibility_bins(states: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    return _bins(_weather(states, date_start, date_end, station), "vis", "visibility_range", "min_vis")


def wind_bins(states: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    return _bins(_weather(states, date_start, date_end, station), "wind", "wind_range", "min_wind")


def _means(states: DataFrame, name: str, shown: dict[str, str]) -> DataFrame:
    """Daily means, with the digits that Spark's own mean of the column keeps."""
    def mean(column: str) -> Column:
        total = f"{name}_sum_{column}"
        value, kind = F.sum(total) / F.sum(f"{name}_seen"), states.schema[total].dataType
        if isinstance(kind, DecimalType):
            # A sum has ten digits more than its column, a mean four more on both sides of the point.
            value = value.cast(DecimalType(min(38, kind.precision - 6), kind.scale + 4))
        return F.round(value, 2).cast("double")

    daily = states.groupBy(F.col(WEATHER_KEYS[0]).alias("date")).agg(
        *[mean(c).alias(label) for label, c in shown.items()], F.sum(f"{name}_seen").alias("observations")
    )
    return daily.filter("observations > 0").orderBy("date")


def visibility_timeline(states: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    return _means(_weather(states, date_start, date_end, station), "vis", {"avg_visibility": "visibility_statute_mi"})


def temperature_stats(states: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    return _means(_weather(states, date_start, date_end, station), "temp", {"avg_temp": "temp_c", "avg_dewpoint": "dewpoint_c"})
