
import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger import catalog, fixtures as fx
from aeroledger.operators import merge, normalize
from aeroledger.plans import features, hourly, model
from aeroledger.operators import associate
from aeroledger.session import reliable_checkpoint
from aeroledger.sources import boards, feeds
from test_sources import BOARD, METAR, TAF

SMOKE = "/root/testdata/sf0.001"
NOW = "2025-10-01 20:00:00"

FLIGHT = (
    "id long, flight_number string, from_airport string, to_airport string, airline_code string, aircraft_code string,"
    " departure_metar_external_id string, arrival_taf_external_id string, departure_metar_fk long, arrival_taf_fk long,"
    " departure_scheduled_utc timestamp_ntz, departure_actual_utc timestamp_ntz, departure_final_utc timestamp_ntz,"
    " departure_terminal string, departure_gate string, arrival_scheduled_utc timestamp_ntz, arrival_actual_utc timestamp_ntz,"
    " arrival_terminal string, arrival_gate string, status string, status_final string, delay_min int"
)
SKY = (
    "id long, metar_fk long, taf_fk long, sky_cover string, cloud_base_ft_agl int, cloud_type string, condition_order short"
)


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    (folder / "raw_CDG_departure_2025-10-01_08h_20251001_081500.html").write_text(BOARD)
    (folder / "m.xml").write_text(METAR)
    (folder / "t.xml").write_text(
        TAF.replace("KJFK</station_id>", "KJFK</station_id>").replace(
            "<forecast><wind_speed_kt>7</wind_speed_kt></forecast>",
            "<forecast><fcst_time_from>2025-10-02T00:00:00Z</fcst_time_from><wind_speed_kt>7</wind_speed_kt>"
            '<sky_condition sky_cover="SCT"/></forecast>',
        )
    )
    airports = spark.createDataFrame(
        [("CDG", "LFPG", "Europe/Paris"), ("JFK", "KJFK", "America/New_York")], "iata_code string, icao_code string, timezone string"
    )
    moment = F.lit(NOW).cast("timestamp_ntz")
    flights = normalize.collected_flights(
        boards.read_boards(spark, str(folder), airports), "s1", "realtime_departures", moment
    )
    flights = reliable_checkpoint(flights)
    return {
        "flights": flights, "metar": feeds.read_metar(spark, str(folder / "m.xml"), moment),
        "taf": feeds.read_taf(spark, str(folder / "t.xml"), moment), "airports": airports, "now": moment,
    }


def tables(spark, documents):
    metar = merge.surrogate_id(normalize.metar_rows(documents["metar"]), ["external_id"]).limit(0)
    taf = merge.surrogate_id(normalize.taf_rows(documents["taf"]), ["external_id"]).limit(0)
    return {
        "flight": spark.createDataFrame([], FLIGHT), "metar": metar, "taf": taf, "sky_condition": spark.createDataFrame([], SKY),
    }


def test_hourly_run(spark, documents):
    d = documents
    # Tables are written between the steps of a run.
    linked = reliable_checkpoint(
        hourly.link_documents(d["flights"], d["metar"], d["taf"], d["airports"], d["now"])
    )
    assert rows(linked, "flight_number", "metar_id", "taf_id") == [
        ("AF1", "LFPG_2025-10-01T12:30:00Z", "KJFK_2025-10-01T10:00:00Z_2025-10-02T00:00:00Z_f0"),
        ("AF2", "LFPG_2025-10-01T12:30:00Z", "KJFK_2025-10-01T10:00:00Z_2025-10-02T00:00:00Z_f0"),
        ("DL3", None, None), ("DL4", None, None),
    ]
    loaded, rejected = hourly.load_session(tables(spark, d), linked, d["metar"], d["taf"], "s1")
    loaded = {n: reliable_checkpoint(t) for n, t in loaded.items()}
    assert {n: t.count() for n, t in loaded.items()} == {"flight": 2, "metar": 1, "taf": 1, "sky_condition": 3}
    assert all(t.count() == 0 for t in rejected.values())
    keys = loaded["metar"].first()["id"], loaded["taf"].first()["id"]
    assert rows(loaded["flight"], "departure_metar_fk", "arrival_taf_fk") == [keys, keys]
    assert rows(loaded["sky_condition"], "sky_cover", "condition_order") == [("BKN", 2), ("FEW", 1), ("SCT", 1)]
    again, _ = hourly.load_session(loaded, linked, d["metar"], d["taf"], "s1")
    assert {n: t.count() for n, t in again.items()} == {"flight": 2, "metar": 1, "taf": 1, "sky_condition": 3}

    past = d["flights"].withColumn("status", F.lit("Landed")).withColumn(
        "arrival", F.col("arrival").withField("delay.minutes", F.lit(42))
    )
    corrected = hourly.correct_flights(loaded["flight"], past, ["_metadata.collected_at", "_id"])
    assert rows(corrected, "flight_number", "status_final", "delay_min") == [("AF1", "Landed", 42), ("AF2", "Landed", 42)]
    assert corrected.filter("arrival_actual_utc is not null and departure_final_utc is not null").count() == 2


def test_train_store_score(spark, tmp_path):
    view = reliable_checkpoint(catalog._view(spark, SMOKE))
    airports = fx.airports(spark, SMOKE)
    hourly.train_and_store(view, airports, str(tmp_path), "1", "decision_tree", sample_size=1500, maxDepth=3)
    trained, stored = model.load(spark, str(tmp_path))
    assert sorted(stored) == sorted(features.FREQUENCIES)
    flights = fx.flights(spark, SMOKE).selectExpr("row_key as id", "delay_prob", "delay_risk_level")
    ids = flights.limit(50).selectExpr("id as f_id")
    updated, summary = model.score_and_store(trained, flights, view, airports, ids, stored)
    row = summary.first()
    assert row["flights"] == ids.distinct().count() and row["low"] + row["medium"] + row["high"] == row["flights"]
    assert updated.count() == flights.count()
    assert abs(row["median_probability"] - row["mean_probability"]) < 1


def test_only_new_flights_ask_for_keys(spark, documents, monkeypatch):
    d = documents
    linked = reliable_checkpoint(hourly.link_documents(d["flights"], d["metar"], d["taf"], d["airports"], d["now"]))
    asked, whole = [], associate.resolve_keys
    monkeypatch.setattr(associate, "resolve_keys", lambda flights, *ids: asked.append(flights.count()) or whole(flights, *ids))
    loaded, _ = hourly.load_session(tables(spark, d), linked.unionByName(linked), d["metar"], d["taf"], "s1")
    loaded = {n: reliable_checkpoint(t) for n, t in loaded.items()}
    assert loaded["flight"].count() == 2
    hourly.load_session(loaded, linked, d["metar"], d["taf"], "s1")
    # External ids that a table holds twice multiply no flight.
    twice = loaded | {"flight": loaded["flight"].limit(0), "metar": loaded["metar"].unionByName(loaded["metar"])}
    again, _ = hourly.load_session(twice, linked, d["metar"], d["taf"], "s1")
    assert rows(again["flight"], "departure_metar_fk", "arrival_taf_fk") == rows(loaded["flight"], "departure_metar_fk", "arrival_taf_fk")
    assert asked == [2, 0, 2]


def test_what_flights_ask_is_written_once(spark, documents, monkeypatch):
    d, written, whole = documents, [], hourly.stored
    monkeypatch.setattr(hourly, "stored", lambda df, label: written.append(label) or whole(df, label))
    hourly.link_documents(d["flights"], d["metar"], d["taf"], d["airports"], d["now"])
    assert written == ["asking"]
