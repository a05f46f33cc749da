"""Flights and late records that land hour by hour; keys that are resolved by hashing."""

from __future__ import annotations

import datetime as dt
import gzip
import pathlib
import zlib

from pyspark.sql import functions as F

from aeroledger import catalog_io, catalog_state
from aeroledger.operators import associate
from aeroledger.streaming import jobs
from tests.conftest import rows

D = dt.datetime(2024, 1, 1, 12)
KEY = "flight_number string, from_airport string, to_airport string, departure_scheduled_utc timestamp_ntz"
LATE = f"{KEY}, collected_at timestamp_ntz, departure_final_utc timestamp_ntz, arrival_actual_utc timestamp_ntz, status_final string, delay_min int"


def hours(n):
    return D + dt.timedelta(hours=n)


def test_a_record_of_a_later_batch_finds_its_flight(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog_state, "BATCH_HOURS", 1)
    flights = [("A1", 0), ("A2", 1), ("A3", 10), ("A4", 30), ("END", 200), (None, 5)]
    late = [("A1", 0, 20), ("A1", 0, 47), ("A2", 1, 60), ("A3", 10, 10), ("A4", 30, 70), ("END", 200, 201), ("X", 3, 9)]
    planned = spark.createDataFrame([(n, "X", "Y", hours(h)) for n, h in flights] + [("NONE", "X", "Y", None)], KEY)
    actual = spark.createDataFrame(
        [(n, "X", "Y", hours(h), hours(at), None, None, f"at {at}", at) for n, h, at in late] + [("A4", "X", "Y", hours(30), None, None, None, "never", 0)], LATE
    )
    sides = [
        catalog_state._landed_hourly(spark, df, moment, str(tmp_path / moment))
        for df, moment in ((planned, "departure_scheduled_utc"), (actual, "collected_at"))
    ]
    joined = jobs.flights_with_actuals(*sides).select("flight_number", "late_status_final")
    jobs.append_available(joined, str(tmp_path / "out"), str(tmp_path / "progress"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.filter("late_status_final is not null")) == [
        ("A1", "at 20"), ("A1", "at 47"), ("A3", "at 10"), ("A4", "at 70"), ("END", "at 201"),
    ]
    # A flight without a record is out when its time has passed.
    assert ("A2", None) in rows(found) and found.filter("flight_number in ('A1', 'A3', 'A4') and late_status_final is null").isEmpty()


def test_hours_land_in_order_with_a_file_each(spark, tmp_path):
    events = spark.range(400, numPartitions=7).select("id", F.expr("timestamp_ntz'1969-12-31 20:00:00' + interval '1' hour * (id % 9)").alias("at"))
    events = events.withColumn("at", F.expr("if(id = 5, null, at)"))
    catalog_state._landed_hourly(spark, events, "at", str(tmp_path / "in"))
    files = sorted((f.stat().st_mtime, int(f.parent.name[5:])) for f in (tmp_path / "in").glob("hour=*/*.parquet"))
    assert len(files) == len({t for t, _ in files}) and [h for _, h in files] == sorted(h for _, h in files)


def test_keys_are_resolved_without_sorting_the_flights(spark):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = {key: spark.conf.get(key) for key in (name, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set(name, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        external = "concat('{}', id % 40) as {}"
        flights = spark.range(600).selectExpr(
            "id", external.format("M", "departure_metar_external_id"), external.format("T", "arrival_taf_external_id"),
            "if(id % 3 = 0, id, null) as departure_metar_fk", "cast(null as bigint) as arrival_taf_fk",
        )
        weather = [spark.range(30).selectExpr(f"concat('{c}', id) as external_id", "id + 1000 as id") for c in "MT"]
        found = associate.resolve_keys(flights, *weather).select("id", "departure_metar_fk", "arrival_taf_fk")
        expected = [
            (i, i if i % 3 == 0 else i % 40 + 1000 if i % 40 < 30 else None, i % 40 + 1000 if i % 40 < 30 else None) for i in range(600)
        ]
        assert sorted(map(tuple, found.collect())) == expected
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ShuffledHashJoin" in plan and "Sort " not in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_exports_are_squeezed_fast_and_restored_whole(spark, monkeypatch):
    names = ("metar", "taf", "sky_condition", "flights")
    shape = [
        "id", "concat_ws('-', id, id * 7 % 20000, id % 1000, id % 7) as row_key", "concat('AP', id % 25) as place",
        "timestamp_ntz'2024-01-01 00:00:00' + interval '1' minute * cast(id as int) as at",
    ]
    for place, name in enumerate(names):
        whole = spark.range(5000 * (place + 1)).selectExpr(*shape)
        monkeypatch.setattr(catalog_io.fx, name, lambda spark, folder, whole=whole: whole)
    found = {r["name"]: r["rows"] for r in catalog_io.restore_counts(spark, "").collect()}
    assert found == {"sky_cover_reference": 9, "metar": 5000, "taf": 10000, "sky_condition": 15000, "flight": 20000}
    paths = catalog_io._restored(spark, "")
    assert rows(spark.read.parquet(paths["flight"])) == rows(catalog_io.fx.flights(spark, ""))
    exports = list(pathlib.Path(paths["flight"].removeprefix("file:")).parents[1].glob("flight/*.csv.gz"))
    assert exports
    for export in exports:
        squeezed = export.read_bytes()
        assert len(squeezed) > 1.05 * len(zlib.compress(gzip.decompress(squeezed), 6))
