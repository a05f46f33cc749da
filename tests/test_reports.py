import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger.functions.columns import between_days
from aeroledger.plans import reports, views

D = dt.datetime(2025, 10, 1)


@pytest.fixture(scope="module")
def flights(spark):
    data = [
        ("a", "AF1", "AF", D.replace(hour=8), 9, 0.6, "high"), ("b", "AF2", "AF", D.replace(hour=8), 10, 0.5, "low"),
        ("c", "ba3", "BA", D.replace(hour=23, minute=59), None, 0.9, "medium"), ("d", "BA4", "BA", D + dt.timedelta(days=1), 15, None, None),
        ("e", "ZZ5", None, None, 30, 0.51, "high"),
    ]
    return spark.createDataFrame(
        data, "row_key string, flight_number string, airline_code string, departure_scheduled_utc timestamp_ntz,"
        " delay_min int, delay_prob double, delay_risk_level string"
    ).withColumns({
        "arrival_scheduled_utc": F.col("departure_scheduled_utc") + F.expr("interval 2 hours"),
        "arrival_actual_utc": F.col("departure_scheduled_utc") + F.expr("interval 130 minutes"),
        "from_airport": F.lit("CDG"), "to_airport": F.lit("JFK"), "departure_metar_fk": F.lit(1).cast("long"),
    })


@pytest.fixture(scope="module")
def metar(spark):
    data = [
        (1, "LFPG", D, 10.0, 4, 0.99, "VFR", "RA"), (2, "LFPG", D, None, 5, 1.0, "IFR", None),
        (3, "KJFK", D + dt.timedelta(days=1), -1.5, 25, 10.0, None, "RA"), (4, "KJFK", D, 0.0, None, None, "VFR", "FG"),
    ]
    return spark.createDataFrame(
        data, "id long, station_id string, observation_time timestamp_ntz, temp_c double, wind_speed_kt int,"
        " visibility_statute_mi double, flight_category string, wx_string string"
    )


def test_days_are_inclusive_and_pushed_down(flights):
    assert rows(between_days(flights, "departure_scheduled_utc", "2025-10-01", "2025-10-01"), "row_key") == [("a",), ("b",), ("c",)]


def test_flight_stats(flights):
    row = reports.flight_stats(flights).first()
    assert (row["total_flights"], row["delayed_flights"], row["delay_rate"], row["flights_with_ml"]) == (5, 3, 60.0, 4)
    assert row["avg_delay"] == 18.33 and row["ml_accuracy"] == 25.0 and row["date_max"] == dt.date(2025, 10, 2)
    empty = reports.flight_stats(flights, date_start="2030-01-01").first()
    assert (empty["total_flights"], empty["delay_rate"], empty["avg_delay"], empty["ml_accuracy"]) == (0, None, 0.0, 0.0)


def test_confusion_and_reliability(flights):
    row = reports.confusion(flights).first()
    assert (row["tp"], row["tn"], row["fp"], row["fn"], row["accuracy"], row["fp_pct"]) == (1, 0, 1, 1, 33.33, 33.3)
    assert reports.confusion(flights.filter("false")).first()["accuracy"] == 0.0
    assert rows(reports.reliability(flights), "risk_level", "total_vols", "vrais_retards", "vols_a_l_heure", "taux_retard_reel") == [
        ("high", 2, 1, 1, 50.0), ("low", 1, 0, 1, 0.0), ("medium", 1, 0, 1, 0.0)
    ]
    assert [r[0] for r in reports.risk_distribution(flights).collect()] == ["low", "medium", "high"]


def test_search_bounds(spark, flights, metar):
    airports = spark.createDataFrame([("CDG", "Paris", "CDG airport")], "iata_code string, city string, airport_name string")
    airlines = spark.createDataFrame([("BA", "British")], "iata string, name string")

    def keys(**kw):
        return [r["row_key"] for r in reports.search_flights(flights, metar, airports, airlines, **kw).collect()]

    assert keys() == ["d", "c", "a", "b"]
    assert keys(date_end="2025-10-01") == ["d", "c", "a", "b"]
    assert keys(departure_date="2025-10-01") == ["c", "a", "b"]
    assert keys(flight_number="BA") == ["d", "c"] and keys(risk_levels=" LOW ,high") == ["a", "b"]
    assert keys(predicted_delay_only=True) == ["c", "a"] and keys(delayed_only=True) == ["d", "b"]
    assert keys(limit=1) == ["d"]
    row = reports.search_flights(flights, metar, airports, airlines, flight_number="ba3").first()
    assert (row["delay_min"], row["airline_name"], row["from_city"], row["to_city"], row["dep_weather_conditions"]) == (
        10.0, "British", "Paris", None, "RA"
    )
    assert row["departure_scheduled_utc"] == "2025-10-01 23:59:00"


def test_bands_and_shares(metar):
    assert rows(reports.visibility_bins(metar), "visibility_range", "count") == [("1-3 mi", 1), ("< 1 mi", 1), (">= 10 mi", 1)]
    assert rows(reports.wind_bins(metar), "wind_range", "count") == [("5-10 kt", 1), ("< 5 kt", 1), (">= 25 kt", 1)]
    assert rows(reports.weather_conditions(metar, top=1)) == [("RA", 2, 66.67)]
    assert rows(reports.flight_categories(metar)) == [("IFR", 1, 33.33), ("VFR", 2, 66.67)]
    assert rows(reports.weather_conditions(metar, station="LFPG")) == [("RA", 1, 100.0)]


def test_extremes_keep_selected(metar):
    got = reports.station_extremes(metar, n=1, selected="KJFK")
    assert rows(got, "kind", "airport", "rank") == [
        ("high_wind", "KJFK", 1), ("low_visibility", "KJFK", None), ("low_visibility", "LFPG", 1)
    ]


def test_worst_hour(spark, flights):
    airlines = spark.createDataFrame([("BA", "British")], "iata string, name string")
    dated = flights.filter("departure_scheduled_utc is not null")
    row = reports.worst_hour_and_airline(reports.hourly_stats(dated), reports.airline_stats(dated, airlines)).first()
    assert (row["worst_hour"], row["worst_hour_rate"], row["riskiest_airline"]) == (0, 100.0, "AF")


def test_wide_view(spark, flights, metar):
    sky = spark.createDataFrame(
        [(1, 1, None, "FEW", 1000, None, 1), (2, 1, None, "BKN", 2000, None, 2), (3, None, 7, "XXX", 1, None, 1)],
        "id long, metar_fk long, taf_fk long, sky_cover string, cloud_base_ft_agl int, cloud_type string, condition_order short",
    )
    taf = spark.createDataFrame([(7, "KJFK", "SN")], "id long, station_id string, wx_string string")
    view = views.wide_view(flights.withColumn("arrival_taf_fk", F.lit(7).cast("long")), metar, taf, sky, key="row_key")
    assert view.count() == 5
    row = view.filter("f_id = 'a'").first()
    assert (row["wx_string"], row["msc_sky_cover_description"], row["t_wx_string"], row["tsc_sky_cover"], row["tsc_sky_cover_description"]) == (
        "RA", "Peu de nuages", "SN", "XXX", None
    )
    ids = spark.createDataFrame([("a",), ("c",), ("a",)], "f_id string")
    assert [r["f_id"] for r in views.flights_by_ids(view, ids).collect()] == ["c", "a"]


def test_one_per_code(spark):
    table = spark.createDataFrame(
        [(3, "AA", "old", "N"), (4, "AA", "new", "Y"), (5, "AA", "newer", "Y"), (1, "BB", "b", None), (2, "BB", "a", "N"), (9, None, "x", "Y")],
        "id long, iata string, name string, active string",
    )
    assert rows(reports.one_per_code(table, "iata", ["name"])) == [("AA", "new"), ("BB", "b")]
