import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger.operators import days
from aeroledger.plans import reports, rollups

D = dt.datetime(2025, 10, 1)
SCHEMA = (
    "row_key string, flight_number string, airline_code string, departure_scheduled_utc timestamp_ntz, delay_min int,"
    " delay_prob double, delay_risk_level string"
)


def flights(spark, numbers=range(60)):
    data = [
        (
            f"k{n}", f"AF{n}", [None, "AF", "BA"][n % 3], None if n == 7 else D + dt.timedelta(days=n % 5, hours=n % 24),
            None if n % 6 == 0 else n - 5, None if n % 4 == 0 else (n % 10) / 10, ["low", "high", None][n % 3],
        )
        for n in numbers
    ]
    return spark.createDataFrame(data, SCHEMA)


def metar(spark):
    data = [
        (n, f"S{n % 4}", None if n == 9 else D + dt.timedelta(days=n % 6), None if n % 5 == 0 else n - 20, None if n % 7 == 0 else n - 25,
         None if n % 3 == 0 else n % 40, None if n % 8 == 0 else n / 4)
        for n in range(90)
    ]
    frame = spark.createDataFrame(data, "id long, station_id string, observation_time timestamp_ntz, t int, d int, wind_speed_kt int, v double")
    return frame.selectExpr(
        "id", "station_id", "observation_time", "cast(t / 7.0 as decimal(5,2)) as temp_c", "cast(d / 3.0 as decimal(5,2)) as dewpoint_c",
        "wind_speed_kt", "cast(v as decimal(5,2)) as visibility_statute_mi",
    )


def listed(root):
    return {os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n)) for folder, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


@pytest.fixture(scope="module")
def states(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("states") / "f")
    schema = rollups.store(rollups.flight_states(flights(spark)), root, reports.SCHEDULED)
    return rollups.read(spark, root, schema, reports.SCHEDULED)


@pytest.mark.parametrize("picked", [{}, {"date_start": "2025-10-02"}, {"date_start": "2025-10-02", "date_end": "2025-10-03"}, {"date_start": "2030-01-01"}])
def test_flight_reports_equal_the_direct_ones(spark, states, picked):
    source = flights(spark)
    for name in ("flight_stats", "daily_stats", "hourly_stats", "confusion"):
        direct, rolled = (getattr(m, name)(t, **picked) for m, t in ((reports, source), (rollups, states)))
        assert direct.columns == rolled.columns and rows(direct) == rows(rolled), name
    names = spark.createDataFrame([("AF", "Air"), ("BA", None)], "iata string, name string")
    assert rows(reports.airline_stats(source, names, **picked)) == rows(rollups.airline_stats(states, names, **picked))


def test_other_thresholds_are_refused(spark, states):
    assert rows(rollups.daily_stats(states, 15)) == rows(reports.daily_stats(flights(spark), 15))
    with pytest.raises(ValueError, match="threshold 20"):
        rollups.daily_stats(states, 20)


@pytest.mark.parametrize("picked", [{}, {"station": "S1"}, {"date_start": "2025-10-02", "date_end": "2025-10-04"}, {"station": "none"}])
def test_weather_reports_equal_the_direct_ones(spark, tmp_path, picked):
    source, root = metar(spark), str(tmp_path / "w")
    schema = rollups.store(rollups.weather_states(source), root, reports.OBSERVED)
    stored = rollups.read(spark, root, schema, reports.OBSERVED)
    for name in ("visibility_bins", "wind_bins", "visibility_timeline", "temperature_stats"):
        direct, rolled = (getattr(m, name)(t, **picked) for m, t in ((reports, source), (rollups, stored)))
        assert direct.columns == rolled.columns and rows(direct) == rows(rolled), name


def test_a_batch_reads_and_replaces_its_days_alone(spark, tmp_path):
    table, root, time = str(tmp_path / "t"), str(tmp_path / "s"), reports.SCHEDULED
    first, batch = flights(spark, range(60)), flights(spark, range(62, 90, 5))
    days.write_days(first, table, time)
    schema = rollups.store(rollups.flight_states(days.read_days(spark, table, first.schema, time)), root, time)
    before = listed(root)
    days.append_days(batch, table, time)
    touched = days.days_of(batch, time)
    assert touched == [dt.date(2025, 10, 3)]
    stored = days.read_days(spark, table, first.schema, time)
    assert files_read(days.of_days(stored, time, touched)) == sum("2025-10-03" in f for f in listed(table)) == 2 < len(listed(table))
    rollups.refresh(stored, root, time, touched, rollups.flight_states)
    after = listed(root)
    assert {f for f in before if f not in after} == {f for f in before if "2025-10-03" in f}
    assert all(after[f] == t for f, t in before.items() if "2025-10-03" not in f)
    whole = first.unionByName(batch)
    assert rows(rollups.daily_stats(rollups.read(spark, root, schema, time))) == rows(reports.daily_stats(whole))
    # A replayed batch changes nothing.
    rollups.refresh(stored, root, time, touched, rollups.flight_states)
    assert rows(rollups.daily_stats(rollups.read(spark, root, schema, time))) == rows(reports.daily_stats(whole))


def test_rows_without_a_time_are_refreshed_too(spark, tmp_path):
    table, root, time = str(tmp_path / "t"), str(tmp_path / "s"), reports.SCHEDULED
    first = flights(spark, range(5))
    days.write_days(first, table, time)
    schema = rollups.store(rollups.flight_states(first), root, time)
    late = flights(spark, [7])
    days.append_days(late, table, time)
    rollups.refresh(days.read_days(spark, table, first.schema, time), root, time, days.days_of(late, time), rollups.flight_states)
    got = rollups.daily_stats(rollups.read(spark, root, schema, time))
    assert rows(got) == rows(reports.daily_stats(first.unionByName(late))) and got.where("date is null").count() == 1


def files_read(frame):
    """Files that the scans of days opened, as counted when the plan ran."""
    frame.collect()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.finalPhysicalPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and "_day" in node.toString():
            found.append(node.metrics().get("numFiles").get().value())
        children = node.children()
        for n in range(children.size()):
            walk(children.apply(n))

    walk(frame._jdf.queryExecution().executedPlan())
    return sum(found)


def plan_of(frame):
    return frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_ranges_prune_days(spark, tmp_path):
    source, root = flights(spark), str(tmp_path / "t")
    days.write_days(source, root, reports.SCHEDULED)
    stored = days.read_days(spark, root, source.schema, reports.SCHEDULED)
    assert rows(stored.select(*source.columns)) == rows(source)
    picked = reports.between_days(stored, reports.SCHEDULED, "2025-10-02", "2025-10-03")
    assert files_read(stored) == 6 and files_read(picked) == 2
    assert files_read(reports.flight_stats(stored, date_start="2025-10-02", date_end="2025-10-03")) == 2
    assert "PartitionFilters: [isnotnull(departure_scheduled_utc_day" in plan_of(reports.flight_stats(stored, date_start="2025-10-02"))
    # The search includes midnight after its last day, and so that day's files.
    shown = source.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("arrival_scheduled_utc", "arrival_actual_utc")})
    shown = shown.withColumns({"from_airport": F.lit("X"), "to_airport": F.lit("Y"), "departure_metar_fk": F.lit(1)})
    days.write_days(shown, str(tmp_path / "u"), reports.SCHEDULED)
    by_day = days.read_days(spark, str(tmp_path / "u"), shown.schema, reports.SCHEDULED)
    places = spark.createDataFrame([("X", "x", "x")], "iata_code string, city string, airport_name string")
    weather = spark.createDataFrame([], "id int, visibility_statute_mi double, flight_category string, temp_c double, wind_speed_kt int, wx_string string")
    names = spark.createDataFrame([], "iata string, name string")
    found = [reports.search_flights(t, weather, places, names, date_start="2025-10-02", date_end="2025-10-02") for t in (shown, by_day)]
    assert rows(found[0]) == rows(found[1]) and found[1].count() > 0
    assert "PartitionFilters: [isnotnull(departure_scheduled_utc_day" in plan_of(found[1])
    assert files_read(found[1]) == 2
