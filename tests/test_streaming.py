import datetime as dt
import hashlib

from conftest import rows
from pyspark.sql import functions as F

from aeroledger.operators import merge
from aeroledger.streaming import jobs
from test_sources import METAR

D = dt.datetime(2025, 10, 1)
EVENTS = "id long, station_id string, observation_time timestamp_ntz"


def drop(spark, folder, name, data, schema=EVENTS):
    """One more landed file."""
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_dedup_over_two_runs(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    drop(spark, source, "a", [(1, "A", D), (2, "A", D)])

    def run():
        stream = jobs.read_new(spark, source, "parquet", EVENTS)
        jobs.append_available(jobs.first_copies(stream, ["id"], "observation_time"), target, progress)
        return rows(spark.read.parquet(target), "id")

    assert run() == [(1,), (2,)]
    assert run() == [(1,), (2,)]
    drop(spark, source, "b", [(2, "A", D), (3, "A", D)])
    assert run() == [(1,), (2,), (3,)]


def test_settled_windows(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    drop(spark, source, "a", [(i, "A", D + dt.timedelta(hours=i // 2)) for i in range(60)])
    stream = jobs.read_new(spark, source, "parquet", EVENTS)
    counts = jobs.settled_windows(stream, "observation_time", "1 hour", jobs.SETTLING, F.count(F.lit(1)).alias("n"))
    jobs.append_available(counts, target, progress)
    got = rows(spark.read.parquet(target), "window_start", "n")
    assert got == [(D + dt.timedelta(hours=h), 2) for h in range(5)]


def test_latest_and_replay(spark, tmp_path):
    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    spark.createDataFrame([], "station_id string, metar_id long, observation_time timestamp_ntz").write.parquet(jobs.version_path(root, 0))

    def run(checkpoint):
        jobs.merge_available(
            jobs.latest_reports(jobs.read_new(spark, source, "parquet", EVENTS)), root, checkpoint, jobs.keep_latest, "update"
        )
        return rows(jobs.read_latest(spark, root), "station_id", "metar_id")

    drop(spark, source, "a", [(1, "A", D), (2, "B", D)])
    assert run(progress) == [("A", 1), ("B", 2)]
    drop(spark, source, "b", [(3, "A", D + dt.timedelta(hours=1)), (4, "B", D - dt.timedelta(hours=1))])
    assert run(progress) == [("A", 3), ("B", 2)]
    versions = jobs.latest_version(spark, root)
    assert run(progress) == [("A", 3), ("B", 2)] and jobs.latest_version(spark, root) == versions
    # A lost checkpoint replays everything from version 0 and ends at the same table.
    assert run(str(tmp_path / "again")) == [("A", 3), ("B", 2)]


def test_merge_steps(spark, tmp_path):
    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    spark.createDataFrame([(1, "old", D)], EVENTS).write.parquet(jobs.version_path(root, 0))
    drop(spark, source, "a", [(1, "new", D), (2, "new", D)])
    jobs.merge_available(jobs.read_new(spark, source, "parquet", EVENTS), root, progress, jobs.insert_step(["id"], ["station_id"]))
    assert rows(jobs.read_latest(spark, root), "id", "station_id") == [(1, "old"), (2, "new")]


def test_flights_with_actuals(spark, tmp_path):
    key = "flight_number string, from_airport string, to_airport string, departure_scheduled_utc timestamp_ntz"
    late = f"{key}, collected_at timestamp_ntz, departure_final_utc timestamp_ntz, arrival_actual_utc timestamp_ntz, status_final string, delay_min int"
    far = D + dt.timedelta(days=9)
    drop(spark, tmp_path / "f", "a", [("A1", "X", "Y", D), ("A2", "X", "Y", D), ("END", "X", "Y", far)], key)
    drop(spark, tmp_path / "l", "a", [
        ("A1", "X", "Y", D, D + dt.timedelta(hours=20), D, D, "LANDED", 3), ("END", "X", "Y", far, far + dt.timedelta(hours=1), far, far, "LANDED", 0),
    ], late)
    joined = jobs.flights_with_actuals(
        jobs.read_new(spark, str(tmp_path / "f"), "parquet", key), jobs.read_new(spark, str(tmp_path / "l"), "parquet", late)
    )
    jobs.append_available(joined.select("flight_number", "late_status_final"), str(tmp_path / "out"), str(tmp_path / "progress"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("A1", "LANDED"), ("A2", None), ("END", "LANDED")]


def test_xml_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(METAR)
    docs = jobs.new_metar(spark, str(tmp_path / "in"), None).select("_id", "station_id")
    jobs.append_available(docs, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    import os

    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    day = "date_format(observation_time, 'yyyy-MM-dd')"
    stored = spark.createDataFrame([(i, "old", D + dt.timedelta(days=i)) for i in range(4)] + [(9, "old", None)], EVENTS)
    jobs.start_partitions(stored, root, F.expr(day))

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{root}/data") for f in names}

    before = files()
    drop(spark, source, "a", [(1, "new", D + dt.timedelta(days=1)), (7, "new", D + dt.timedelta(days=9))])
    stream = jobs.read_new(spark, source, "parquet", EVENTS)
    jobs.merge_partitions_available(stream, root, progress, lambda table, batch: merge.upsert(table, batch, ["id"]), day)
    assert rows(jobs.read_partitions(spark, root), "id", "station_id") == [
        (0, "old"), (1, "new"), (2, "old"), (3, "old"), (7, "new"), (9, "old"),
    ]
    after = files()
    assert all(after[name] == stamp for name, stamp in before.items())
    new = {name.split(f"{jobs.PLACE}=")[1][:32] for name in after.keys() - before.keys() if f"{jobs.PLACE}=" in name}
    assert new == {hashlib.md5(f"={d}".encode()).hexdigest() for d in ("2025-10-02", "2025-10-10")}
    assert rows(jobs.read_partitions(spark, root, 0), "id", "station_id")[1] == (1, "old")
    assert jobs.read_partitions(spark, root, parts=["1999-01-01"]).count() == 0


def test_late_files_and_repeats(spark, tmp_path):
    import os

    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    spark.createDataFrame([], "station_id string, metar_id long, observation_time timestamp_ntz").write.parquet(jobs.version_path(root, 0))

    def run():
        stream = jobs.latest_reports(jobs.read_new(spark, source, "parquet", EVENTS))
        jobs.merge_available(stream, root, progress, jobs.keep_latest, "update")
        return rows(jobs.read_latest(spark, root), "station_id", "metar_id")

    drop(spark, source, "a", [(1, "A", D)])
    assert run() == [("A", 1)]
    known = set(os.listdir(source))
    drop(spark, source, "b", [(2, "B", D), (1, "A", D)])
    for name in set(os.listdir(source)) - known:
        os.utime(f"{source}/{name}", (1_000_000_000, 1_000_000_000))
    assert run() == [("A", 1), ("B", 2)]


def test_repeated_flights_keep_one_row(spark, tmp_path):
    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    flight = "flight_key string, to_airport string, operated_by string, arrival_scheduled_utc timestamp_ntz"
    taf = spark.createDataFrame([(5, "LFPG", D, None, "FM")], "id long, station_id string, fcst_time_from timestamp_ntz, fcst_time_to timestamp_ntz, change_indicator string")
    airports = spark.createDataFrame([("CDG", "LFPG")], "iata_code string, icao_code string")
    spark.createDataFrame([], "flight_key string, taf_id long").write.parquet(jobs.version_path(root, 0))
    step = jobs.link_step(taf, airports, ["flight_key"], ["arrival_scheduled_utc"])
    for _ in range(2):
        drop(spark, source, "a", [("f1", "CDG", None, D + dt.timedelta(hours=1)), ("f2", None, None, D), ("f1", "CDG", None, D)], flight)
        jobs.merge_available(jobs.read_new(spark, source, "parquet", flight), root, progress, step)
    assert rows(jobs.read_latest(spark, root)) == [("f1", 5), ("f2", None)]
