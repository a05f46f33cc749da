"""The read queries behind the dashboards, as DataFrame functions.

Parameters are typed predicates. Each aggregate keeps counts and sums only, so
Spark combines them before the shuffle and one hot day, airline or station costs
one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import (
    between_days,
    count_if,
    day,
    from_day,
    minutes_between,
    percent,
    risk_rank,
    until,
)

SCHEDULED = "departure_scheduled_utc"
OBSERVED = "observation_time"


def _delayed(threshold: int) -> Column:
    return count_if(F.col("delay_min") >= threshold)


# ---- flights -----------------------------------------------------------------

def flight_stats(flights: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    late = F.col("delay_min") >= delay_threshold
    scored = F.col("delay_prob").isNotNull()
    right = (F.col("delay_prob") > 0.5) & late | (F.col("delay_prob") <= 0.5) & ~late
    return between_days(flights, SCHEDULED, date_start, date_end).agg(
        F.count(F.lit(1)).alias("total_flights"),
        count_if(late).alias("delayed_flights"),
        percent(count_if(late), F.nullif(F.count(F.lit(1)), F.lit(0))).alias("delay_rate"),
        F.coalesce(F.round(F.avg(F.when(late, F.col("delay_min"))), 2), F.lit(0.0)).alias("avg_delay"),
        count_if(scored).alias("flights_with_ml"),
        # A null delay counts as a wrong prediction here.
        F.coalesce(
            percent(count_if(scored & right), F.nullif(count_if(scored), F.lit(0))), F.lit(0.0)
        ).alias("ml_accuracy"),
        F.to_date(F.min(SCHEDULED)).alias("date_min"),
        F.to_date(F.max(SCHEDULED)).alias("date_max"),
    )


def daily_stats(flights: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    return (
        between_days(flights, SCHEDULED, date_start, date_end)
        .groupBy(F.to_date(SCHEDULED).alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            _delayed(delay_threshold).alias("delayed"),
            percent(_delayed(delay_threshold), F.count(F.lit(1))).alias("delay_rate"),
        )
        .orderBy("date")
    )


def hourly_stats(flights: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    return (
        between_days(flights, SCHEDULED, date_start, date_end)
        .groupBy(F.hour(SCHEDULED).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("flights"),
            percent(_delayed(delay_threshold), F.count(F.lit(1))).alias("delay_rate"),
        )
        .orderBy("hour")
    )


def airline_stats(
    flights: DataFrame, airlines: DataFrame, delay_threshold: int = 10, top: int = 15,
    date_start=None, date_end=None,
) -> DataFrame:
    """Busiest airlines, listed by delay rate. The limit comes before the join."""
    busiest = (
        between_days(flights.filter(F.col("airline_code").isNotNull()), SCHEDULED, date_start, date_end)
        .groupBy(F.col("airline_code").alias("airline"))
        .agg(
            F.count(F.lit(1)).alias("flights"),
            percent(_delayed(delay_threshold), F.count(F.lit(1))).alias("delay_rate"),
        )
        .orderBy(F.desc("flights"), "airline")
        .limit(top)
    )
    return named_airlines(busiest, airlines)


def named_airlines(busiest: DataFrame, airlines: DataFrame) -> DataFrame:
    names = one_per_code(airlines, "iata", ["name"]).toDF("airline", "airline_name")
    return (
        busiest.join(names, "airline", "left")
        .select("airline", "airline_name", "flights", "delay_rate")
        .orderBy("delay_rate", "airline")
    )


def one_per_code(table: DataFrame, code: str, columns: list[str]) -> DataFrame:
    """One row per code: an active one before others, then the smallest id, then the first values."""
    order = [F.coalesce(F.col("active") != "Y", F.lit(True))] if "active" in table.columns else []
    order += ["id"] if "id" in table.columns else []
    picked = table.filter(F.col(code).isNotNull()).groupBy(code).agg(
        F.min_by(F.struct(*columns), F.struct(*order, *columns)).alias("picked")
    )
    return picked.select(code, "picked.*")


def worst_hour_and_airline(hourly: DataFrame, by_airline: DataFrame) -> DataFrame:
    """Hour and airline with the highest delay rate; the first one wins a tie."""
    hour = hourly.agg(
        F.max_by("hour", F.struct("delay_rate", -F.col("hour"))).alias("worst_hour"),
        F.max("delay_rate").alias("worst_hour_rate"),
    )
    ranked = by_airline.select(F.struct(-F.col("delay_rate"), "airline").alias("k"), "*")
    airline = ranked.agg(
        F.min_by(F.coalesce("airline_name", "airline"), "k").alias("riskiest_airline"),
        F.max("delay_rate").alias("riskiest_airline_rate"),
    )
    return one_row(hour, airline)


def one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames side by side, without a cross join."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def confusion(flights: DataFrame, delay_threshold: int = 10, date_start=None, date_end=None) -> DataFrame:
    """Prediction against outcome; flights without a known delay fall in no cell."""
    scored = between_days(flights.filter(F.col("delay_prob").isNotNull()), SCHEDULED, date_start, date_end)
    said, late = F.col("delay_prob") > 0.5, F.col("delay_min") >= delay_threshold
    cells = scored.agg(
        count_if(said & late).alias("tp"),
        count_if(~said & ~late).alias("tn"),
        count_if(said & ~late).alias("fp"),
        count_if(~said & late).alias("fn"),
    )
    return confusion_shares(cells)


def confusion_shares(cells: DataFrame) -> DataFrame:
    """Counts of the four cells with their shares of all."""
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")

    def share(part: Column, places: int) -> Column:
        return F.when(total > 0, F.bround(part / total * 100.0, places)).otherwise(F.lit(0.0))

    return cells.select(
        "tp", "tn", "fp", "fn",
        share(F.col("tp") + F.col("tn"), 2).alias("accuracy"),
        *[share(F.col(c), 1).alias(f"{c}_pct") for c in ("tp", "tn", "fp", "fn")],
    )


def risk_distribution(flights: DataFrame, date_start=None, date_end=None) -> DataFrame:
    return (
        between_days(flights.filter(F.col("delay_risk_level").isNotNull()), SCHEDULED, date_start, date_end)
        .groupBy("delay_risk_level")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(risk_rank("delay_risk_level"))
    )


def reliability(flights: DataFrame, delay_threshold: int = 15) -> DataFrame:
    """Risk level against observed delay; an unknown delay counts as on time."""
    late = F.col("delay_min") >= delay_threshold
    return (
        flights.filter(F.col("delay_risk_level").isNotNull())
        .groupBy(F.col("delay_risk_level").alias("risk_level"))
        .agg(
            F.count(F.lit(1)).alias("total_vols"),
            count_if(late).alias("vrais_retards"),
            count_if(~late | F.col("delay_min").isNull()).alias("vols_a_l_heure"),
        )
        .withColumn(
            "taux_retard_reel", F.bround(F.col("vrais_retards") / F.col("total_vols") * 100.0, 1)
        )
        .orderBy(risk_rank("risk_level"))
    )


def filter_options(flights: DataFrame) -> DataFrame:
    """Distinct airlines, and risk levels with their counts, in list order."""
    codes = (
        flights.filter(F.col("airline_code").isNotNull())
        .select(F.col("airline_code").alias("value")).distinct()
        .select(F.lit("airline").alias("kind"), "value", F.lit(None).cast("long").alias("count"))
    )
    levels = risk_distribution(flights).select(
        F.lit("risk_level").alias("kind"), F.col("delay_risk_level").alias("value"), "count"
    )
    return codes.unionByName(levels).orderBy("kind", risk_rank("value"), "value")


def search_flights(
    flights: DataFrame, metar: DataFrame, airports: DataFrame, airlines: DataFrame, *,
    flight_number: str | None = None, departure_date=None, date_start=None, date_end=None,
    airline_code: str | None = None, risk_levels: str | None = None, delayed_only: bool = False,
    predicted_delay_only: bool = False, has_ml_prediction: bool = False,
    delay_min_threshold: int = 10, limit: int = 10_000, key: str = "row_key",
) -> DataFrame:
    """Filtered flights, newest departure first, with names and weather.

    Filters and the top-n run on the flight table alone; the joins then touch at
    most ``limit`` rows on the flight side.
    """
    hits = flights.filter(F.col(SCHEDULED).isNotNull())
    if flight_number:
        hits = hits.filter(F.col("flight_number").ilike(f"%{flight_number}%"))
    hits = between_days(hits, SCHEDULED, departure_date, departure_date)
    if date_start is not None:
        hits = from_day(hits, SCHEDULED, date_start)
    if date_end is not None:
        # Both ends included: midnight after the last day still matches.
        hits = until(hits, SCHEDULED, day(date_end) + dt.timedelta(days=1), included=True)
    if airline_code:
        hits = hits.filter(F.col("airline_code") == airline_code)
    if risk_levels:
        levels = [level.strip().lower() for level in risk_levels.split(",")]
        hits = hits.filter(F.col("delay_risk_level").isin(levels))
    if delayed_only:
        hits = hits.filter(F.col("delay_min") >= delay_min_threshold)
    if predicted_delay_only:
        hits = hits.filter(F.col("delay_prob") > 0.5)
    if has_ml_prediction:
        hits = hits.filter(F.col("delay_prob").isNotNull())
    page = hits.orderBy(F.desc(SCHEDULED), key).limit(limit)

    places = one_per_code(airports, "iata_code", ["city", "airport_name"])

    def place(end: str) -> DataFrame:
        return places.toDF(f"{end}_airport", f"{end}_city", f"{end}_airport_name")

    weather = metar.select(
        F.col("id").alias("departure_metar_fk"),
        F.col("visibility_statute_mi").alias("dep_visibility_mi"),
        F.col("flight_category").alias("dep_flight_category"),
        F.col("temp_c").alias("dep_temp_c"),
        F.col("wind_speed_kt").alias("dep_wind_speed_kt"),
        F.col("wx_string").alias("dep_weather_conditions"),
    )
    names = one_per_code(airlines, "iata", ["name"]).toDF("airline_code", "airline_name")

    def shown(name: str) -> Column:
        return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss").alias(name)

    return (
        page.join(weather, "departure_metar_fk", "left")
        .join(place("from"), "from_airport", "left")
        .join(place("to"), "to_airport", "left")
        .join(names, "airline_code", "left")
        .orderBy(F.desc(SCHEDULED), key)
        .select(
            key, "flight_number", "from_airport", "from_city", "from_airport_name",
            "to_airport", "to_city", "to_airport_name", "airline_code", "airline_name",
            shown(SCHEDULED), shown("arrival_scheduled_utc"), shown("arrival_actual_utc"),
            F.coalesce(
                F.col("delay_min").cast("double"),
                minutes_between("arrival_actual_utc", "arrival_scheduled_utc"),
            ).alias("delay_min"),
            "delay_prob", "delay_risk_level", "dep_visibility_mi", "dep_flight_category",
            "dep_temp_c", "dep_wind_speed_kt", "dep_weather_conditions",
        )
    )


# ---- weather -----------------------------------------------------------------

def _reports(metar: DataFrame, date_start, date_end, station) -> DataFrame:
    if station:
        metar = metar.filter(F.col("station_id") == station)
    return between_days(metar, OBSERVED, date_start, date_end)


def meteo_stats(
    metar: DataFrame, taf: DataFrame, sky: DataFrame, date_start=None, date_end=None, station=None
) -> DataFrame:
    """One scan per table; the sky count ignores the filters."""
    forecasts = taf.filter(F.col("station_id") == station) if station else taf
    forecasts = between_days(forecasts, "issue_time", date_start, date_end)

    def summary(df: DataFrame, label: str, when: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias(f"total_{label}"),
            F.countDistinct("station_id").alias(f"airports_{label}"),
            F.to_date(F.min(when)).alias(f"date_min_{label}"),
            F.to_date(F.max(when)).alias(f"date_max_{label}"),
        )

    return one_row(
        summary(_reports(metar, date_start, date_end, station), "metar", OBSERVED),
        summary(forecasts, "taf", "issue_time"),
        sky.agg(F.count(F.lit(1)).alias("total_sky_conditions")),
    )


def _share_of_total(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts per value with their share of all rows.

    The rollup adds the grand total as one more group, which sorts first. With
    ``top`` the limit comes before the window, so its one task sees ``top`` rows.
    """
    counts = df.rollup(column).agg(
        F.count(F.lit(1)).alias("count"), F.grouping(column).alias("is_total")
    )
    if top is not None:
        counts = counts.orderBy(F.desc("is_total"), F.desc("count"), column).limit(top + 1)
    total = F.max(F.when(F.col("is_total") == 1, F.col("count"))).over(W.partitionBy())
    return (
        counts.withColumn("percentage", percent(F.col("count"), total))
        .filter("is_total = 0")
        .select(F.col(column).alias("condition"), "count", "percentage")
        .orderBy(F.desc("count"), "condition")
    )


def flight_categories(metar: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    known = metar.filter(F.col("flight_category").isNotNull())
    return _share_of_total(_reports(known, date_start, date_end, station), "flight_category")


def weather_conditions(
    metar: DataFrame, date_start=None, date_end=None, station=None, top: int = 20
) -> DataFrame:
    """Most frequent weather strings; the share is of all strings, not of the top."""
    known = metar.filter(F.col("wx_string").isNotNull())
    return _share_of_total(_reports(known, date_start, date_end, station), "wx_string", top)


def top_airports(metar: DataFrame, limit: int = 20, date_start=None, date_end=None) -> DataFrame:
    def mean(column: str) -> Column:
        return F.round(F.avg(column), 2).cast("double")

    return (
        _reports(metar.filter(F.col("temp_c").isNotNull()), date_start, date_end, None)
        .groupBy(F.col("station_id").alias("airport"))
        .agg(
            F.count(F.lit(1)).alias("observations"),
            mean("temp_c").alias("avg_temp"),
            mean("wind_speed_kt").alias("avg_wind_speed"),
            mean("visibility_statute_mi").alias("avg_visibility"),
        )
        .orderBy(F.desc("observations"), "airport")
        .limit(limit)
    )


def top_plus_selected(
    ranked: DataFrame, order: list[Column], n: int, key: str, selected: str | None
) -> DataFrame:
    """First ``n`` rows plus the selected one; beyond ``n`` it carries no rank.

    ``ranked`` is the result of a limit, so its one window task is bounded.
    """
    place = ranked.withColumn("place", F.row_number().over(W.orderBy(*order)))
    keep = F.col("place") <= n
    if selected is not None:
        keep = keep | (F.col(key) == selected)
    return place.filter(keep).withColumn("rank", F.when(F.col("place") <= n, F.col("place"))).drop("place")


def station_extremes(
    metar: DataFrame, n: int = 20, among: int = 200, selected: str | None = None,
    date_start=None, date_end=None,
) -> DataFrame:
    """Lowest visibility and strongest wind among the most observed stations."""
    observed = top_airports(metar, among, date_start, date_end)
    low = top_plus_selected(
        observed.filter(F.col("avg_visibility").isNotNull()),
        [F.asc("avg_visibility"), F.asc("airport")], n, "airport", selected,
    ).withColumn("kind", F.lit("low_visibility"))
    windy = top_plus_selected(
        observed.filter(F.col("avg_wind_speed").isNotNull()),
        [F.desc("avg_wind_speed"), F.asc("airport")], n, "airport", selected,
    ).withColumn("kind", F.lit("high_wind"))
    return low.unionByName(windy)


# Report bands as (label, upper bound); the last has none.
VISIBILITY_BANDS = [("< 1 mi", 1), ("1-3 mi", 3), ("3-5 mi", 5), ("5-10 mi", 10), (">= 10 mi", None)]
WIND_BANDS = [
    ("< 5 kt", 5), ("5-10 kt", 10), ("10-15 kt", 15), ("15-20 kt", 20), ("20-25 kt", 25), (">= 25 kt", None),
]


def band(column: str, bands: list[tuple[str, int | None]]) -> Column:
    label = F.lit(bands[-1][0])
    for name, upper in reversed(bands[:-1]):
        label = F.when(F.col(column) < upper, name).otherwise(label)
    return label


def _band_counts(metar: DataFrame, column: str, bands, label: str, low: str, dates) -> DataFrame:
    return (
        _reports(metar.filter(F.col(column).isNotNull()), *dates)
        .groupBy(band(column, bands).alias(label))
        .agg(F.count(F.lit(1)).alias("count"), F.min(column).alias(low))
        .orderBy(low)
    )


def visibility_bins(metar: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    return _band_counts(
        metar, "visibility_statute_mi", VISIBILITY_BANDS, "visibility_range", "min_vis",
        (date_start, date_end, station),
    )


def wind_bins(metar: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    return _band_counts(
        metar, "wind_speed_kt", WIND_BANDS, "wind_range", "min_wind", (date_start, date_end, station)
    )


def _daily_means(df: DataFrame, means: dict[str, str]) -> DataFrame:
    return (
        df.groupBy(F.to_date(OBSERVED).alias("date"))
        .agg(
            *[F.round(F.avg(c), 2).cast("double").alias(name) for name, c in means.items()],
            F.count(F.lit(1)).alias("observations"),
        )
        .orderBy("date")
    )


def visibility_timeline(metar: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    seen = metar.filter(F.col("visibility_statute_mi").isNotNull())
    return _daily_means(
        _reports(seen, date_start, date_end, station), {"avg_visibility": "visibility_statute_mi"}
    )


def temperature_stats(metar: DataFrame, date_start=None, date_end=None, station=None) -> DataFrame:
    seen = metar.filter(F.col("temp_c").isNotNull() & F.col("dewpoint_c").isNotNull())
    return _daily_means(
        _reports(seen, date_start, date_end, station),
        {"avg_temp": "temp_c", "avg_dewpoint": "dewpoint_c"},
    )
