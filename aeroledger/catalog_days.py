"""Registered queries over tables and states that are laid out by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from .catalog import _old_airlines, _search, query, with_doubles
from .operators import days
from .plans import reports, rollups
from .session import run_dir

# Rows of the days from here on come in two batches.
LATE_DAYS = "timestamp_ntz'2024-01-20 00:00:00'"


def _two_batches(table, time, key):
    """A first load, and a later batch that touches the last days only."""
    later = (F.col(time) >= F.expr(LATE_DAYS)) & (F.pmod(F.xxhash64(key), F.lit(5)) == 0)
    return table.where(~later | F.col(time).isNull()), table.where(later)


def _rolled_up(spark, table, time, key, states_of):
    """Day states built from a first load and refreshed for the days of a second one."""
    rows, states = run_dir(spark, "by_day"), run_dir(spark, "day_states")
    first, batch = _two_batches(table, time, key)
    days.write_days(first, rows, time)
    schema = rollups.store(states_of(days.read_days(spark, rows, table.schema, time)), states, time)
    days.append_days(batch, rows, time)
    rollups.refresh(days.read_days(spark, rows, table.schema, time), states, time, days.days_of(batch, time), states_of)
    return rollups.read(spark, states, schema, time)


def _flight_states(spark, folder):
    return _rolled_up(spark, fx.flights(spark, folder), reports.SCHEDULED, "row_key", rollups.flight_states)


def _weather_states(spark, folder):
    return _rolled_up(spark, fx.metar(spark, folder), reports.OBSERVED, "id", rollups.weather_states)


@query
def rollup_flight_stats(spark, folder):
    return rollups.flight_stats(_flight_states(spark, folder), date_start="2024-01-03", date_end="2024-01-27")


@query
def rollup_daily_stats(spark, folder):
    return rollups.daily_stats(_flight_states(spark, folder))


@query
def rollup_hourly_stats(spark, folder):
    return rollups.hourly_stats(_flight_states(spark, folder))


@query
def rollup_airline_stats(spark, folder):
    airlines = fx.airlines(spark, folder)
    return rollups.airline_stats(_flight_states(spark, folder), airlines.unionByName(_old_airlines(airlines)), top=3)


@query
def rollup_confusion(spark, folder):
    return rollups.confusion(_flight_states(spark, folder))


@query
def rollup_visibility_bins(spark, folder):
    return with_doubles(rollups.visibility_bins(_weather_states(spark, folder)))


@query
def rollup_wind_bins(spark, folder):
    return rollups.wind_bins(_weather_states(spark, folder))


@query
def rollup_visibility_timeline(spark, folder):
    return rollups.visibility_timeline(_weather_states(spark, folder), station="ZZ03")


@query
def rollup_temperature_stats(spark, folder):
    return rollups.temperature_stats(_weather_states(spark, folder))


def _stored_flights(spark, folder):
    flights = fx.flights(spark, folder)
    root = run_dir(spark, "flights")
    days.write_days(flights, root, reports.SCHEDULED)
    return days.read_days(spark, root, flights.schema, reports.SCHEDULED)


@query
def search_by_day(spark, folder):
    """The search over flights laid out by departure day: other days' files are not opened."""
    return _search(
        spark, folder, flights=_stored_flights(spark, folder), flight_number="a1", date_start="2024-01-05",
        date_end="2024-01-25", risk_levels="Low, medium", has_ml_prediction=True,
    )


@query
def flight_stats_by_day(spark, folder):
    return reports.flight_stats(_stored_flights(spark, folder), date_start="2024-01-03", date_end="2024-01-27")
