"""DuckDB statements for queries over day states: what the plain reports give."""

from .reports import SQL as REPORTS

SQL = {f"rollup_{name}": REPORTS[name] for name in (
    "flight_stats", "daily_stats", "hourly_stats", "airline_stats", "visibility_bins", "wind_bins", "visibility_timeline", "temperature_stats",
)} | {"rollup_confusion": REPORTS["ml_confusion"], "search_by_day": REPORTS["search_flights"], "flight_stats_by_day": REPORTS["flight_stats"]}
