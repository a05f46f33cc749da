import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger.functions import sql, text, weather
from aeroledger.operators import dims, merge, quality, snapshots
from aeroledger.sources import documents, feeds
from aeroledger.streaming import jobs, states

D = dt.datetime(2025, 10, 1)
REPORTS = "station_id string, metar_id long, observation_time timestamp_ntz"


def land(spark, folder, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))


# ---- state with timers ------------------------------------------------------------------

def test_reports_end_after_a_day(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def hours(n):
        return D + dt.timedelta(hours=n)

    def run():
        stream = jobs.read_new(spark, source, "parquet", REPORTS)
        with states.timers(spark):
            jobs.append_available(states.newest_with_timers(stream), target, progress)
        return rows(states.current(spark.read.parquet(target)), "station_id", "metar_id", "observation_time", "ended")

    land(spark, source, [("A", 1, hours(0)), ("A", 2, hours(2)), ("B", 3, hours(1)), ("A", 4, hours(2))], REPORTS)
    assert run() == [("A", 4, hours(2), False), ("B", 3, hours(1), False)]
    land(spark, source, [("C", 5, hours(25.5)), ("A", 6, hours(2))], REPORTS)
    # The report of B is a day old, the one of A is not; an older repeat changes nothing.
    assert run() == [("A", 4, hours(2), False), ("B", 3, hours(1), True), ("C", 5, hours(25.5), False)]
    land(spark, source, [("B", 7, hours(40))], REPORTS)
    assert run() == [("A", 4, hours(2), True), ("B", 7, hours(40), False), ("C", 5, hours(25.5), False)]
    assert run() == run()
    assert spark.conf.get(states.PROVIDER[0]) != states.PROVIDER[1]


def test_state_holds_only_stations_of_the_last_day(spark, tmp_path):
    """A hundred stations that report once each, a day and a half apart: at most two are held."""
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for n in range(6):
        land(spark, source, [(f"S{n}", n, D + dt.timedelta(hours=36 * n))], REPORTS)
    stream = jobs.read_new(spark, source, "parquet", REPORTS, files_per_batch=1)
    with states.timers(spark):
        query = (
            states.newest_with_timers(stream).writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", progress).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    ended = spark.read.parquet(target).where("change = 'ended'")
    assert rows(ended, "station_id") == [(f"S{n}",) for n in range(5)]


# ---- digest tree ------------------------------------------------------------------------

def copy(spark, changed=()):
    data = [(n, None if n % 7 == 0 else f"v{n}", n / 2) for n in range(500)]
    data = [(n, "new" if n in changed else v, x) for n, v, x in data] + [(1, "v1", 0.5)] * 3
    return spark.createDataFrame(data, "k long, v string, x double")


def test_only_buckets_that_differ_are_read(spark, tmp_path):
    old, new, same = copy(spark), copy(spark, {3, 400}), copy(spark).repartition(7)
    places = {name: str(tmp_path / name) for name in ("old", "new", "same")}
    for name, rows_of in (("old", old), ("new", new), ("same", same)):
        snapshots.store(rows_of, places[name], 64, 8)
    assert snapshots.changed_buckets(spark, places["old"], places["same"], 8) == []
    assert snapshots.delta(spark, places["old"], places["same"], old.schema, 8).count() == 0
    buckets = snapshots.changed_buckets(spark, places["old"], places["new"], 8)
    assert 1 <= len(buckets) <= 4
    found = snapshots.delta(spark, places["old"], places["new"], old.schema, 8)
    assert rows(found) == rows(dims.snapshot_delta(old, new)) and found.count() == 4
    # The files of all other buckets may be gone.
    for name in ("old", "new"):
        for folder in os.listdir(f"{places[name]}/rows"):
            if folder.startswith(snapshots.BUCKET) and int(folder.split("=")[1]) not in buckets:
                for file in os.listdir(f"{places[name]}/rows/{folder}"):
                    open(f"{places[name]}/rows/{folder}/{file}", "wb").close()
    assert rows(snapshots.delta(spark, places["old"], places["new"], old.schema, 8)) == rows(dims.snapshot_delta(old, new))


def test_copies_with_other_row_counts_differ(spark, tmp_path):
    one = copy(spark)
    snapshots.store(one, str(tmp_path / "a"), 16, 4)
    snapshots.store(one.unionByName(one.limit(1)), str(tmp_path / "b"), 16, 4)
    snapshots.store(one.limit(0), str(tmp_path / "c"), 16, 4)
    assert snapshots.delta(spark, str(tmp_path / "a"), str(tmp_path / "b"), one.schema, 4).count() == 1
    gone = snapshots.delta(spark, str(tmp_path / "a"), str(tmp_path / "c"), one.schema, 4)
    assert gone.agg(F.sum("copies")).first()[0] == 503 and rows(gone.select("change").distinct()) == [("removed",)]


# ---- checks while writing ---------------------------------------------------------------

def test_checks_while_writing_equal_the_report(spark, tmp_path):
    sky = spark.createDataFrame([(1, 1, None), (2, None, None), (3, 5, 6), (4, None, 2)], "id long, metar_fk long, taf_fk long")
    metar = spark.createDataFrame([(1, "A", "VFR"), (5, None, "odd"), (6, "B", None)], "id long, station_id string, flight_category string")
    checks = [
        quality.Check("one_parent", "sky", "condition", condition="(metar_fk is null) = (taf_fk is null)"),
        quality.Check("station", "metar", "not_null", ("station_id",)),
        quality.Check("category", "metar", "accepted", ("flight_category",), values=("VFR", "IFR")),
        quality.Check("parent", "sky", "relationship", ("metar_fk",), parent=("metar", "id")),
    ]
    tables = {"sky": sky, "metar": metar}
    found = quality.write_checked(tables, str(tmp_path), checks)
    whole = quality.report(tables, [c for c in checks if c.kind in quality.ROW_KINDS])
    assert rows(found, "check", "violations") == rows(whole, "check", "violations") == [("category", 1), ("one_parent", 2), ("station", 1)]
    assert rows(spark.read.parquet(str(tmp_path / "sky"))) == rows(sky)


# ---- broken records ---------------------------------------------------------------------

def test_broken_feed_elements_go_to_quarantine(spark, tmp_path):
    good = "<METAR><station_id>LFPG</station_id><observation_time>2025-10-01T10:00:00Z</observation_time></METAR>"
    lines = [good, "<METAR><station_id>BAD</METAR>", good.replace("LFPG", "KJFK"), "<METAR><station_id>&nope;</station_id></METAR>", "<METAR><station_id>OPEN</station_id>", good.replace("LFPG", "EGLL")]
    (tmp_path / "a.xml").write_text("<data>\n" + "\n".join(lines) + "\n</data>")
    docs, broken = feeds.read_checked(spark, str(tmp_path), "METAR")
    assert rows(docs, "station_id") == [("EGLL",), ("KJFK",), ("LFPG",)]
    assert rows(docs.drop("_metadata")) == rows(feeds.metar_from_text(spark.createDataFrame([(g,) for g in (good, lines[2], lines[5])], "t string"), "t", F.current_timestamp()).drop("_metadata"))
    kept = broken.collect()
    assert len(kept) == 3 and all(r["file"].endswith("a.xml") and r["block_start"] == 0 for r in kept)
    assert any("BAD" in r["record"] for r in kept)


def test_broken_json_goes_to_quarantine(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.json").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    good, bad = documents.read_json_checked(spark, str(tmp_path / "l"), "a long", lines=True)
    assert rows(good, "a") == [(1,), (3,)] and rows(bad, "record") == [('{"a": ',)]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "good.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "w" / "bad.json").write_text('[{"a": 3}, {"a"')
    good, bad = documents.read_json_checked(spark, str(tmp_path / "w"), "a long")
    assert rows(good, "a") == [(1,), (2,)]
    assert [r["file"].rsplit("/", 1)[1] for r in bad.collect()] == ["bad.json"]


# ---- tables bucketed alike --------------------------------------------------------------

def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_bucketed_target_is_not_shuffled(spark, tmp_path):
    schema = (
        "doc_id string, status string, collection_session_id string, is_updated boolean, update_count long,"
        " last_updated_at timestamp_ntz, previous_collection_session_id string, metar_id string"
    )
    target = spark.createDataFrame([(f"d{n}", "old", "s1", False, 0, None, None, None) for n in range(60)], schema)
    source = spark.createDataFrame([(f"d{n}", f"new{n}", "s2", None, n % 3) for n in range(50, 70)], "doc_id string, status string, collection_session_id string, metar_id string, seq int")
    stored = merge.store_bucketed(target, "docs_bucketed", "doc_id", 4, str(tmp_path / "b"))
    now, keep = F.expr("timestamp_ntz'2025-01-01 00:00:00'"), ("metar_id",)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.replace_upsert(stored, source, "doc_id", ["seq"], now, keep)
        plain = merge.replace_upsert(target, source, "doc_id", ["seq"], now, keep)
        plan = plan_of(merged)
        assert rows(merged) == rows(plain) and merged.count() == 70
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop table docs_bucketed")
    scan = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scan) == 1 and "Bucketed: true" in scan[0]
    depth = scan[0].index("FileScan")
    above, limit = [], depth
    for line in reversed(plan.splitlines()[: plan.splitlines().index(scan[0])]):
        place = len(line) - len(line.lstrip(" :+-"))
        if place < limit:
            above.append(line)
            limit = place
    assert not any("Exchange" in line for line in above)


# ---- SQL functions ----------------------------------------------------------------------

def test_functions_in_sql_text(spark):
    names = sql.register(spark)
    assert {"trigram_similarity", "decode_weather", "weather_severity", "board_rows"} <= set(names)
    pairs = spark.createDataFrame([("Air France", "air france!"), ("Air", "Boat"), ("", "x"), (None, "y"), ("", "")], "a string, b string")
    grams = [text.trigrams(F.coalesce(c, F.lit(""))) for c in ("a", "b")]
    want = pairs.where("a is not null").select("a", "b", text.similarity(*grams).alias("s"))
    pairs.createOrReplaceTempView("name_pairs")
    assert rows(spark.sql("select a, b, trigram_similarity(a, b) as s from name_pairs where a is not null")) == rows(want)
    codes = spark.createDataFrame([(c,) for c in ("+TSRA", "-SN BR", "", None, "CLEAR", "XX", "VCFG", "FZRA+", "Q")], "wx string")
    codes.createOrReplaceTempView("codes")
    found = spark.sql("select wx, decode_weather(wx) as words, weather_severity(wx) as kind from codes")
    assert rows(found) == rows(codes.select("wx", weather.decode_wx(F.col("wx")), weather.severity_class(F.col("wx"))))


def test_board_pages_beside_their_row(spark):
    sql.register(spark)
    page = (
        '<table class="flightsTable"><tr><th>h</th></tr><tr><td><a href="/f?d=2024-01-16">FL1</a></td><td><a>Town [XYZ]</a></td>'
        '<td>x</td><td><span>08:05</span></td><td>10:30</td><td><span>On time</span></td></tr></table>'
    )
    pages = spark.createDataFrame([(1, "/raw_ABC_departure_2024-01-15_08h_20240115_081500.html", page), (2, "/b.html", "<html></html>")], "k int, path string, html string")
    pages.createOrReplaceTempView("pages_now")
    found = spark.sql("select p.k, b.place, b.error from pages_now p, lateral board_rows(p.path, p.html) b")
    assert rows(found) == [(1, 0, None)]


# ---- tables by partition ----------------------------------------------------------------

STORED = "id long, part string, v string"


@pytest.mark.parametrize("names", [("2025-01-01 10:00:00", "a/b=c %"), ("", None), ("é:1", "x y")])
def test_partition_names_of_any_kind(spark, tmp_path, names):
    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    jobs.start_partitions(spark.createDataFrame([(n, name, "old") for n, name in enumerate(names)], STORED), root, F.col("part"))
    land(spark, source, [(0, names[0], "new"), (9, "more", "new")], STORED)
    stream = jobs.read_new(spark, source, "parquet", STORED)
    jobs.merge_partitions_available(stream, root, progress, lambda table, batch: merge.upsert(table, batch, ["id"]), "part")
    want = sorted([(0, names[0], "new"), (1, names[1], "old"), (9, "more", "new")], key=repr)
    assert rows(jobs.read_partitions(spark, root)) == want
    assert rows(jobs.read_partitions(spark, root, parts=[names[1]])) == [(1, names[1], "old")]


def test_a_row_that_moves_leaves_its_old_partition(spark, tmp_path):
    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    jobs.start_partitions(spark.createDataFrame([(1, "d1", "old"), (2, "d1", "old"), (3, "d3", "old"), (4, "d4", "old")], STORED), root, F.col("part"))
    land(spark, source, [(1, "d2", "new"), (4, "d2", "new")], STORED)
    stream = jobs.read_new(spark, source, "parquet", STORED)
    jobs.merge_partitions_available(
        stream, root, progress, lambda table, batch: merge.upsert(table, batch, ["id"]), "part", moved_by=["id"]
    )
    assert rows(jobs.read_partitions(spark, root)) == [(1, "d2", "new"), (2, "d1", "old"), (3, "d3", "old"), (4, "d2", "new")]
    assert jobs.read_partitions(spark, root, parts=["d4"]).count() == 0


def test_old_versions_go(spark, tmp_path):
    source, root, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    jobs.start_partitions(spark.createDataFrame([(1, "a", "0"), (2, "b", "0")], STORED), root, F.col("part"))
    for n in range(1, 5):
        land(spark, source, [(1, "a", str(n))], STORED)
    stream = jobs.read_new(spark, source, "parquet", STORED, files_per_batch=1)
    jobs.merge_partitions_available(
        stream, root, progress, lambda table, batch: merge.upsert(table, batch, ["id"]), "part", keep_versions=2
    )
    # Part b still lies where version 0 wrote it.
    kept = rows(jobs.read_partitions(spark, root))
    assert kept[1] == (2, "b", "0") and kept[0][:2] == (1, "a")
    assert len([n for n in os.listdir(f"{root}/manifest") if n.startswith("version=")]) == 2
    assert os.path.isdir(f"{root}/data/version=0") and len(os.listdir(f"{root}/data/version=0")) >= 1
