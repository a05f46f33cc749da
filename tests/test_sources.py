import datetime as dt
import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger.functions.clean import split_valid
from aeroledger.operators import normalize
from aeroledger.sources import boards, documents, feeds, landing, reference

METAR = """<response><data num_results="3">
<METAR><raw_text>LFPG</raw_text><station_id>LFPG</station_id><observation_time>2025-10-01T12:30:00Z</observation_time>
<temp_c>12.345</temp_c><wind_dir_degrees>VRB</wind_dir_degrees><wind_speed_kt>5</wind_speed_kt>
<visibility_statute_mi>6+</visibility_statute_mi>
<sky_condition sky_cover="FEW" cloud_base_ft_agl="1200"/><sky_condition sky_cover="BKN"/></METAR>
<METAR><station_id>EGLL</station_id><observation_time>2025-10-01T12:20:00Z</observation_time></METAR>
<METAR><raw_text>no station</raw_text></METAR>
<METAR/>
</data></response>"""

TAF = """<response><data>
<TAF><station_id>LFPG</station_id><issue_time>2025-10-01T11:00:00Z</issue_time></TAF>
<TAF><station_id>EGLL</station_id><bulletin_time>2025-10-01T11:00:00Z</bulletin_time>
<forecast><fcst_time_from>2025-10-01T12:00:00Z</fcst_time_from><fcst_time_to>2025-10-02T12:00:00Z</fcst_time_to>
<sky_condition sky_cover="OVC"/></forecast>
<forecast/>
<forecast><fcst_time_from>2025-10-01T15:00:00Z</fcst_time_from><change_indicator>FM</change_indicator></forecast></TAF>
<TAF><station_id>KJFK</station_id><issue_time>2025-10-01T10:00:00Z</issue_time>
<forecast><wind_speed_kt>7</wind_speed_kt></forecast></TAF>
</data></response>"""


def test_metar_feed(spark, tmp_path):
    with gzip.open(tmp_path / "metars.xml.gz", "wt") as f:
        f.write(METAR)
    docs = feeds.read_metar(spark, str(tmp_path))
    assert docs.count() == 3
    known = {r["_id"]: r for r in docs.collect()}
    first = known["LFPG_2025-10-01T12:30:00Z"]
    assert first["_metadata"]["xml_file"] == "metars.xml.gz" and first["_metadata"]["data_type"] == "METAR"
    assert any(k.startswith("metar_") for k in known)
    good, bad = split_valid(normalize.metar_rows(docs), ["external_id", "station_id"])
    assert (good.count(), bad.count()) == (2, 1)
    row = good.filter("station_id = 'LFPG'").first()
    assert (float(row["temp_c"]), row["wind_dir_degrees"], row["wind_speed_kt"], float(row["visibility_statute_mi"])) == (
        12.34, None, 5, 6.0
    )
    assert rows(normalize.sky_rows(docs), "sky_cover", "condition_order") == [("BKN", 2), ("FEW", 1)]


def test_taf_feed(spark, tmp_path):
    (tmp_path / "tafs.xml").write_text(TAF)
    docs = feeds.read_taf(spark, str(tmp_path))
    assert rows(docs, "_id", "_metadata.data_type", "_metadata.forecast_index") == [
        ("EGLL_2025-10-01T11:00:00Z_2025-10-01T12:00:00Z_2025-10-02T12:00:00Z_f0", "TAF_FORECAST", 0),
        ("EGLL_2025-10-01T11:00:00Z_2025-10-01T15:00:00Z_f2", "TAF_FORECAST", 2),
        ("KJFK_2025-10-01T10:00:00Z_f0", "TAF_FORECAST", 0),
        ("LFPG_2025-10-01T11:00:00Z_base", "TAF_BASE", None),
    ]
    table = normalize.taf_rows(docs)
    row = table.filter("change_indicator = 'FM'").first()
    assert (row["fcst_time_from"], row["fcst_time_to"]) == (dt.datetime(2025, 10, 1, 15), None)
    assert rows(normalize.sky_rows(docs, "forecast_sky_condition"), "sky_cover") == [("OVC",)]


def flight_row(number, times="<span>08:10</span>", status="On time", arrival="2025-10-02T10:30:00.000", href="/x?d=2025-10-01"):
    return (
        f'<tr><td><a href="{href}">{number}</a></td><td><a>New York [JFK]</a></td><td>Line</td><td>{times}'
        '<span class="terminal">2E</span><span class="gate">K4</span></td><td>10:30</td>'
        f'<td><span>{status}</span><button data-arrivaltime="{arrival}"></button></td></tr>'
    )


BOARD = (
    '<html><table class="flightsTable"><tr class="flightsTable-header"><td>x</td></tr><tr><th>h</th></tr>'
    + flight_row("AF1")
    + flight_row("AF2", '<s>08:10</s><span class="estimatedTime depDelayed" data-delay="35">08:45 [02/10]</span>')
    + flight_row("DL3") + '<tr class="compensation-row" data-cs="ZZ9"><td>This flight is Operated By AF22</td></tr>'
    + flight_row("DL4") + '<tr class="compensation-row" data-cs="ZZ9"><td>code share</td></tr>'
    + "<tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr></table></html>"
)


def test_boards(spark, tmp_path):
    name = "raw_CDG_departure_2025-10-01_08h_20251001_081500.html"
    (tmp_path / name).write_text(BOARD)
    (tmp_path / "raw_CDG_arrival_2025-10-01_08h_20251001_081500.html").write_text(
        BOARD.replace("</table>", '</table><span class="noflights">none</span>')
    )
    (tmp_path / "raw_JFK_departure_2025-10-01_08h_20251001_081500.html").write_text("<p>empty</p>")
    airports = spark.createDataFrame(
        [("CDG", "Europe/Paris"), ("JFK", "America/New_York")], "iata_code string, timezone string"
    )
    docs = boards.read_boards(spark, str(tmp_path), airports)
    found = {r["flight_number"]: r.asDict(True) for r in docs.collect()}
    assert sorted(found) == ["AF1", "AF2", "DL3", "DL4"]
    one, two = found["AF1"], found["AF2"]
    assert (one["from_code"], one["to_code"], one["status"], one["airline"]) == ("CDG", "JFK", "On time", "Line")
    assert one["departure"] == {
        "date": "2025-10-01", "scheduled": "08:10", "estimated": "08:10", "scheduled_utc": "2025-10-01T06:10:00Z",
        "estimated_utc": "2025-10-01T06:10:00Z", "gate": "K4", "terminal": "2E",
        "delay": {"is_delayed": False, "minutes": 0},
    }
    assert one["arrival"]["scheduled_utc"] == "2025-10-02T14:30:00Z"
    assert two["departure"]["estimated"] == "08:45" and two["departure"]["delay"] == {"is_delayed": True, "minutes": 35}
    assert (found["DL3"]["operated_by"], found["DL4"]["operated_by"], one["operated_by"]) == ("AF22", "ZZ9", None)
    table = normalize.flight_rows(docs)
    assert rows(table.filter("flight_number = 'AF1'"), "airline_code", "departure_scheduled_utc", "delay_min") == [
        ("AF", dt.datetime(2025, 10, 1, 6, 10), None)
    ]


def test_landing(spark, tmp_path):
    for stamp in ("20251001_081500", "20251001_083000"):
        (tmp_path / f"raw_CDG_departure_2025-10-01_08h_{stamp}.html").write_text("x")
    (tmp_path / "raw_cdg_wrong.html").write_text("x")
    import os

    old = tmp_path / "raw_JFK_arrival_2025-09-01_08h_20250901_081500.html"
    old.write_text("xyz")
    os.utime(old, (1, 1))
    os.utime(tmp_path / "raw_CDG_departure_2025-10-01_08h_20251001_081500.html", (2_000_000_000, 2_000_000_000))
    os.utime(tmp_path / "raw_CDG_departure_2025-10-01_08h_20251001_083000.html", (2_000_000_600, 2_000_000_600))
    now = F.timestamp_seconds(F.lit(2_000_003_600)).cast("timestamp_ntz")
    files = landing.catalog(landing.list_files(spark, str(tmp_path)), now)
    assert files.count() == 3
    assert [r["timestamp"] for r in landing.newest_first(files).collect()][0] == "20251001_083000"
    assert rows(landing.newest_per_key(files), "airport", "filename") == [
        ("CDG", "raw_CDG_departure_2025-10-01_08h_20251001_083000.html")
    ]
    assert rows(landing.expired(files, 24), "filename") == [(old.name,)]
    totals = landing.totals(files).first()
    assert (totals["total_files"], totals["airports"], totals["newest_file_age_hours"]) == (3, 2, 0.8)
    assert landing.catalog(landing.list_files(spark, str(tmp_path)), now, airport="jfk").count() == 1


def test_reference_files(spark, tmp_path):
    (tmp_path / "ref.csv").write_text(
        "code_iata;icao_code;timezone;name\n CDG ;LFPG;Europe/Paris;Old\nCDG;LFPX;Europe/Paris;New\n;ZZZZ;UTC;None\nJFK;KJFK;America/New_York;Kennedy\n"
    )
    ref = reference.airport_reference(spark, str(tmp_path / "ref.csv"))
    assert rows(ref, "code_iata", "icao_code", "name") == [("CDG", "LFPX", "New"), ("JFK", "KJFK", "Kennedy")]
    assert rows(reference.first_airports(ref, 1), "code_iata") == [("CDG",)]
    assert reference.airport_reference_or_fallback(spark, str(tmp_path / "absent.csv")).count() == 10
    (tmp_path / "airlines.csv").write_text(
        "id,name,alias,iata,icao,callsign,country_name,active\n1,Air Namibia,\\N,SW,NMB,NAMIBIA,NA,Y\n2,Other,\\N,\\N,OTH,x,France,N\n"
    )
    lines = reference.headerless_csv(spark, str(tmp_path / "airlines.csv"), "airlines")
    assert rows(lines, "id", "alias", "iata", "country_name") == [("1", None, "SW", "NA"), ("2", None, None, "France")]
    assert reference.sky_cover_reference(spark).count() == 9


def test_seed_and_restore(spark, tmp_path):
    (tmp_path / "fleet.csv").write_text("Brand,Average_Age,Place\nPorter,1.6,1\n")
    target = reference.load_seed(spark, str(tmp_path / "fleet.csv"), "Brand string, Average_Age string, Place string", str(tmp_path / "raw"))
    assert spark.read.parquet(target).count() == 1
    with gzip.open(tmp_path / "metar.csv.gz", "wt") as f:
        f.write("id,observation_time\n1,2025-10-01 12:00:00\n")
    done = reference.restore_tables(
        spark, {"metar": str(tmp_path / "metar.csv.gz")}, {"metar": "id long, observation_time timestamp_ntz"}, str(tmp_path / "silver")
    )
    assert rows(spark.read.parquet(done["metar"])) == [(1, dt.datetime(2025, 10, 1, 12))]


def test_paged_reference(spark, tmp_path):
    (tmp_path / "p1.json").write_text(
        '{"CountryResource": {"Countries": {"Country": [{"CountryCode": "DK", "Names": {"Name": {"$": "Denmark"}}}]}}}'
    )
    (tmp_path / "p2.json").write_text(
        '{"CountryResource": {"Countries": {"Country": [{"CountryCode": "NA", "Names": {"Name": {"$": "Namibia"}}}]}}}'
    )
    assert rows(reference.paged_reference(spark, str(tmp_path), "countries")) == [("DK", "Denmark"), ("NA", "Namibia")]
    for kind in reference.PAGED:
        empty = spark.createDataFrame([], reference.paged_schema(kind))
        assert reference.flatten_pages(empty, kind).columns == list(reference.PAGED[kind][2])


def test_documents(spark, tmp_path):
    (tmp_path / "combined_arrival_2025-07-31.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "combined_odd.json").write_text('{"a": 3}')
    (tmp_path / "other.json").write_text('{"a": 4}')
    docs = documents.read_combined(spark, str(tmp_path), "a long")
    assert rows(documents.documents_per_file(docs)) == [
        ("combined_arrival_2025-07-31.json", "arrival", "2025-07-31", 2), ("combined_odd.json", "unknown", "unknown", 1)
    ]
    single = documents.read_json_with_provenance(spark, str(tmp_path / "other.json"), "a long")
    assert rows(single, "a", "provenance.source_file") == [(4, "other.json")]
    documents.write_json(single.select("a"), str(tmp_path / "out"))
    assert documents.read_json(spark, str(tmp_path / "out"), "a long").count() == 1
    documents.write_predictions_csv(single.select("a"), str(tmp_path / "csv"))
    assert documents.read_flight_csv(spark, str(tmp_path / "csv"), ["a"]).first()["a"] == "4"


def test_board_pages_with_unclosed_tags(spark):
    page = BOARD.replace("<td", "<p>" * 5000 + "<td", 1) + "</b>" * 5000
    pages = spark.createDataFrame([("raw_a.html", page), ("raw_b.html", None), ("raw_c.html", "<![x[ <![if")], "path string, html string")
    assert boards.unreadable_pages(pages).count() <= 1
    found = boards.board_rows(pages).filter("path = 'raw_a.html'")
    assert found.count() == boards.board_rows(spark.createDataFrame([("raw_a.html", BOARD)], pages.schema)).count()


def test_landing_lookup(spark):
    files = spark.createDataFrame([
        ("CDG", "departure", "2025-10-01", "08", 3600.0, "f1", "/f1"), ("CDG", "departure", "2025-10-01", "08", 7200.0, "f0", "/f0"),
        ("JFK", "departure", "2025-10-01", "08", 90_000.0, "f2", "/f2"),
    ], "airport string, type string, date string, shift string, age_seconds double, filename string, path string").withColumn(
        "modified", F.lit(dt.datetime(2025, 10, 2)) - F.make_dt_interval(secs=F.col("age_seconds"))
    )
    wanted = spark.createDataFrame([(a, "departure", "2025-10-01", "08") for a in ("CDG", "JFK", "LHR")], "airport string, type string, date string, shift string")
    assert rows(landing.lookup(files, wanted), "airport", "status", "filename", "path") == [
        ("CDG", "found", "f1", "/f1"), ("JFK", "too old", "f2", None), ("LHR", "missing", None, None),
    ]


def test_reference_fallback_only_without_a_file(spark, tmp_path):
    from pyspark.errors import AnalysisException

    fallback = reference.airport_reference_or_fallback(spark, str(tmp_path / "absent.csv"))
    assert fallback.columns == ["code_iata", "icao_code", "timezone"] and fallback.count() == 10
    (tmp_path / "odd.csv").write_text("code;zone\nCDG;Europe/Paris\n")
    with pytest.raises(AnalysisException):
        reference.airport_reference_or_fallback(spark, str(tmp_path / "odd.csv")).count()
