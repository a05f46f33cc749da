import datetime as dt

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroledger.operators import merge

ROW = "id long, v string, seq long"
NOW = dt.datetime(2025, 10, 2)


def frame(spark, data, schema=ROW):
    return spark.createDataFrame(data, schema)


def test_insert_ignore_first_wins(spark):
    target = frame(spark, [(1, "old", 0)])
    source = frame(spark, [(1, "new", 1), (2, "b", 2), (2, "a", 1)])
    assert rows(merge.insert_ignore(target, source, ["id"], ["seq"])) == [(1, "old", 0), (2, "a", 1)]
    counts = merge.insert_counts(target, source.withColumn("batch", F.lit(1)), ["id"], ["seq"], "batch")
    assert rows(counts) == [(1, 3, 1, 2)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from("abc"), st.integers(0, 9)), min_size=1, max_size=12))
def test_merges_are_idempotent(spark, data):
    target = frame(spark, [(0, "t", 0), (3, "t", 0)])
    source = frame(spark, data)
    once = merge.insert_ignore(target, source, ["id"], ["seq", "v"])
    assert rows(merge.insert_ignore(once, source, ["id"], ["seq", "v"])) == rows(once)
    up = merge.upsert(target, source, ["id"], ["seq", "v"])
    assert rows(merge.upsert(up, source, ["id"], ["seq", "v"])) == rows(up)
    assert up.select("id").distinct().count() == up.count()


DOC = (
    "doc_id string, status string, metar_id string, collection_session_id string, is_updated boolean, update_count int, "
    "last_updated_at timestamp_ntz, previous_collection_session_id string"
)


def test_replace_upsert(spark):
    target = frame(spark, [
        ("a", "old", "M1", "s1", False, 0, None, None), ("b", "old", None, "s1", True, 2, None, "s0"),
    ], DOC)
    source = frame(spark, [
        ("a", "new", None, "s2", 1), ("c", "one", None, "s2", 1), ("d", "one", None, "s2", 1), ("d", "two", "M9", "s2", 2),
    ], "doc_id string, status string, metar_id string, collection_session_id string, seq int")
    got = merge.replace_upsert(target, source, "doc_id", ["seq"], F.lit(NOW).cast("timestamp_ntz"))
    assert rows(got) == [
        ("a", "new", "M1", "s2", True, 1, NOW, "s1"),
        ("b", "old", None, "s1", True, 2, None, "s0"),
        ("c", "one", None, "s2", False, 0, None, None),
        ("d", "two", "M9", "s2", True, 1, NOW, "s2"),
    ]
    assert got.dtypes == target.dtypes


def test_late_actuals(spark):
    plan = dt.datetime(2025, 10, 1, 8)
    key = "flight_number string, from_airport string, to_airport string, departure_scheduled_utc timestamp_ntz"
    flights = frame(spark, [(1, "AF1", "CDG", "JFK", plan, "x", 5), (2, "AF1", "CDG", "JFK", None, "y", 6)],
                    f"id long, {key}, status_final string, delay_min int")
    late = frame(spark, [
        ("AF1", "CDG", "JFK", plan, plan, plan, "LANDED", 12, 1), ("AF1", "CDG", "JFK", plan, plan, plan, "DIVERTED", None, 2),
        ("AF1", "CDG", "JFK", None, plan, plan, "Z", 1, 3), ("", "CDG", "JFK", plan, plan, plan, "Z", 1, 3),
    ], f"{key}, departure_final_utc timestamp_ntz, arrival_actual_utc timestamp_ntz, status_final string, delay_min int, seq int")
    got = merge.late_actuals(flights, late, ["seq"])
    assert rows(got, "id", "departure_final_utc", "status_final", "delay_min") == [
        (1, plan, "DIVERTED", None), (2, None, "y", 6)
    ]
    again = merge.insert_flights(flights.select(*merge.FLIGHT_KEY, "id"), flights.select(*merge.FLIGHT_KEY, "id"), ["id"])
    assert again.filter("departure_scheduled_utc is not null").count() == 1


def test_write_back(spark):
    flights = frame(spark, [(1, 0.1, "low"), (2, 0.2, "low"), (3, None, None)], "id long, delay_prob double, delay_risk_level string")
    scores = frame(spark, [(1, 0.9, None), (2, float("nan"), "high"), (3, 0.4, "medium"), (9, 0.1, "low")],
                   "id long, delay_probability double, risk_level string")
    assert rows(merge.write_back_predictions(flights, scores)) == [(1, 0.9, None), (2, 0.2, "low"), (3, 0.4, "medium")]


def test_links_cascade_children(spark):
    flights = frame(spark, [(1, "old"), (2, None)], "id long, metar_id string")
    links = frame(spark, [(2, "M2")], "id long, metar_id string")
    assert rows(merge.set_links(flights, links, "id", ["metar_id"])) == [(1, "old"), (2, "M2")]
    sky = frame(spark, [(1, 10, None), (2, 11, None), (3, None, 5)], "id long, metar_fk long, taf_fk long")
    parents = frame(spark, [(10,)], "id long")
    assert rows(merge.cascade_delete(sky, "metar_fk", parents), "id") == [(1,), (3,)]
    added, layers = merge.insert_with_children(
        frame(spark, [(10, "x", 0)]), frame(spark, [(10, "x", 1), (11, "y", 1)]), ["id"], ["seq"], sky, "metar_fk", "id"
    )
    assert rows(added, "id") == [(11,)] and rows(layers, "id") == [(2,)]


def test_ids_and_versions(spark, tmp_path):
    df = frame(spark, [(1, "a", 0), (2, "b", 0)])
    first, second = (merge.surrogate_id(df, ["v"], "key") for _ in range(2))
    assert rows(first) == rows(second)
    path = merge.write_version(df, str(tmp_path), "7")
    assert spark.read.parquet(path).count() == 2
