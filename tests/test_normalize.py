import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger.functions import clean, weather, zones
from aeroledger.operators import normalize
from aeroledger.sources import reference


def one(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_decimal(spark):
    texts = ["10+", "6+", "VRB", "CAVOK", "-", "-1.5", "10.5", "0", "", None, "2.345", "2.355", "1-2"]
    got = column(one(spark, texts), clean.clean_decimal("x"))
    want = ["10.00", "6.00", None, None, None, "-1.50", "10.50", "0.00", None, None, "2.34", "2.36", None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_decimal_out_of_range_is_null(spark):
    assert column(one(spark, ["123456.7"]), clean.clean_decimal("x")) == [None]


def test_integer(spark):
    texts = ["10+", "VRB", "-", "-7", "10.5", "", None, "1-2", " 30 kt"]
    df = one(spark, texts)
    assert column(df, clean.clean_integer("x")) == [10, None, None, -7, 105, None, None, None, 30]
    assert column(df, clean.lost_decimal_point("x")) == [False] * 4 + [True] + [False] * 4


def test_timestamp(spark):
    texts = [
        "2025-10-01T12:30:45Z", "2025-10-01T12:30:45.000Z", "2025-10-01 12:30:45", "20251001_123045",
        "2025-10-01T12:30", "2025-10-01", "nonsense", None, "", "2025-13-01T00:00:00",
    ]
    full = dt.datetime(2025, 10, 1, 12, 30, 45)
    got = column(one(spark, texts), clean.clean_timestamp("x"))
    assert got == [full, full, full, full, dt.datetime(2025, 10, 1, 12, 30), None, None, None, None, None]


def test_numbers_beside_text(spark):
    df = spark.createDataFrame(
        [("VRB", "12", "a"), ("080", "6+", "b"), ("x", "1.5", "c")], "wind_dir_degrees string, temp_c string, other string"
    )
    got = clean.with_numbers(df)
    assert got.columns == ["wind_dir_degrees", "temp_c", "other", "wind_dir_degrees_num", "temp_c_num"]
    assert rows(got, "wind_dir_degrees_num", "temp_c_num") == sorted(
        [(None, 12.0), (80.0, None), (None, 1.5)], key=repr
    )


def test_flatten(spark):
    df = spark.sql("select named_struct('b', 1, 'c', named_struct('d', 2)) as a, array(1) as l, 3 as z")
    assert clean.flatten(df, exclude=("z",)).columns == ["a_b", "a_c_d", "l"]


def test_split_valid(spark):
    df = spark.createDataFrame([("a", "x"), ("", "y"), (None, "z")], "id string, s string")
    good, bad = clean.split_valid(df, ["id", "s"])
    assert (good.count(), bad.count()) == (1, 2)


def test_local_to_utc(spark):
    cases = [
        ("2025-03-30 02:30:00", "Europe/Paris", "2025-03-30 01:30:00"),
        ("2025-10-26 02:30:00", "Europe/Paris", "2025-10-26 01:30:00"),
        ("2025-07-01 12:00:00", "Europe/Paris", "2025-07-01 10:00:00"),
        ("2025-11-02 01:30:00", "America/New_York", "2025-11-02 06:30:00"),
        ("2025-03-09 02:30:00", "America/New_York", "2025-03-09 07:30:00"),
        ("2025-04-06 01:45:00", "Australia/Lord_Howe", "2025-04-05 15:15:00"),
        ("2025-07-01 12:00:00", None, None),
    ]
    df = spark.createDataFrame([(i, a, z) for i, (a, z, _) in enumerate(cases)], "i int, x string, zone string")
    got = column(df, zones.local_to_utc(F.col("x").cast("timestamp_ntz"), F.col("zone")))
    assert [None if g is None else str(g) for g in got] == [c[2] for c in cases]


def test_local_to_utc_matches_pytz(spark):
    pytz = pytest.importorskip("pytz")
    start = dt.datetime(2025, 1, 1)
    cases = []
    for zone in ("Europe/Paris", "America/New_York", "Asia/Tokyo", "Australia/Sydney", "Australia/Lord_Howe"):
        for i in range(0, 365 * 24, 5):
            local = start + dt.timedelta(hours=i, minutes=(i * 7) % 60)
            utc = pytz.timezone(zone).localize(local).astimezone(pytz.utc).replace(tzinfo=None)
            cases.append((local, zone, utc))
    df = spark.createDataFrame(cases, "x timestamp_ntz, zone string, want timestamp_ntz")
    wrong = df.withColumn("got", zones.local_to_utc(F.col("x"), F.col("zone"))).filter("not (got <=> want)")
    assert wrong.collect() == []


def test_expected_board(spark):
    airports = spark.createDataFrame(
        [("CDG", "Europe/Paris"), ("JFK", "America/New_York"), ("XXX", "")], "iata_code string, timezone string"
    )
    early = F.lit("2025-07-01 23:10:00").cast("timestamp_ntz")
    late = F.lit("2025-07-01 23:40:00").cast("timestamp_ntz")
    assert rows(zones.expected_board_hour(airports, early, 1)) == [
        ("CDG", "Europe/Paris", "2025-07-02", "01", "2025-07-02 01:00:00", "2:00:00"),
        ("JFK", "America/New_York", "2025-07-01", "19", "2025-07-01 19:00:00", "-1 day, 20:00:00"),
    ]
    assert rows(zones.expected_board_hour(airports, late, -20), "iata_code", "board_date", "shift") == [
        ("CDG", "2025-07-01", "05"), ("JFK", "2025-06-30", "23")
    ]
    assert rows(zones.expected_board_hour(airports, late, 1), "iata_code", "shift") == [("CDG", "02"), ("JFK", "20")]


def test_weather_words(spark):
    texts = ["TSRA", "+SN", "FZRA", "XX", "", None, "CLEAR", "-RA BR", "RA+", "XRA", "+"]
    got = column(one(spark, texts), weather.decode_wx(F.col("x")))
    w = weather.WX_WORDS
    clear = weather.CLEAR_SKY
    assert got == [
        f"{w['TS']} + {w['RA']}", f"Fort {w['SN']}", f"{w['FZ']} + {w['RA']}", "XX", clear, clear, clear,
        f"Faible {w['RA']} + {w['BR']}", f"{w['RA']} + {w['+']}", w["RA"], "+",
    ]


def test_weather_classes(spark):
    texts = ["TSRA", "+SN", "FZRA", "SN", "RA", "FG", "DS", "XX", "", None]
    assert column(one(spark, texts), weather.severity_class(F.col("x"))) == [
        "storm", "storm", "storm", "snow", "rain", "fog", "other", "other", "clear", "clear"
    ]


def test_weather_impact(spark):
    texts = ["TSRA", "+SN", "FZRA", "FG", "BR", "+RA", "-RA", "DS", "XX", "", None, "SQ", "GR", "sn", "IC", "nan"]
    df = one(spark, texts)
    parts = weather.impact(F.col("x"))
    assert list(zip(column(df, parts["weather_impact"]), column(df, parts["weather_simplified"]))) == [
        ("high", "THUNDERSTORM"), ("medium", "SNOW"), ("medium", "ICING"), ("high", "FOG"), ("low", "LIGHT_WEATHER"),
        ("medium", "RAIN"), ("low", "LIGHT_WEATHER"), ("high", "DUST_STORM"), ("none", "CLEAR"), ("none", "CLEAR"),
        ("none", "CLEAR"), ("high", "THUNDERSTORM"), ("high", "HAIL"), ("medium", "SNOW"), ("none", "CLEAR"),
        ("none", "CLEAR"),
    ]
    assert column(df, parts["has_icing"])[2] and column(df, parts["has_icing"])[14]


def test_delay_minutes(spark):
    base = dt.datetime(2025, 1, 1, 12)
    df = spark.createDataFrame(
        [(0, base, base + dt.timedelta(seconds=90)), (1, base, base - dt.timedelta(seconds=90)), (2, base, None)],
        "i int, plan timestamp_ntz, real timestamp_ntz",
    )
    assert column(df, normalize.delay_minutes(F.col("real"), F.col("plan"))) == [1, -1, None]
    assert column(df, normalize.late_minutes(F.col("real"), F.col("plan"))) == [1, 0, None]


def test_flight_id(spark):
    df = spark.createDataFrame(
        [(0, "AF1", "CDG", "JFK", "2025-10-01T12:30:00Z"), (1, "AF1", "", "JFK", None), (2, None, "CDG", "JFK", "")],
        "i int, n string, a string, b string, t string",
    )
    assert column(df, normalize.flight_id(F.col("n"), F.col("a"), F.col("b"), F.col("t"))) == [
        "AF1_CDG_JFK_20251001_1230", "AF1_JFK_UNKNOWN_TIME", "CDG_JFK_UNKNOWN_TIME"
    ]


def test_sky_layers(spark):
    docs = spark.sql(
        "select 'm' as _id, array(named_struct('sky_cover', 'FEW', 'cloud_base_ft_agl', '1000', 'cloud_type', null),"
        " named_struct('sky_cover', '', 'cloud_base_ft_agl', '2000', 'cloud_type', null),"
        " named_struct('sky_cover', 'BKN', 'cloud_base_ft_agl', null, 'cloud_type', 'CB'),"
        " named_struct('sky_cover', 'OVC', 'cloud_base_ft_agl', '4000', 'cloud_type', null),"
        " named_struct('sky_cover', 'VV', 'cloud_base_ft_agl', '5000', 'cloud_type', null)) as sky_condition"
    )
    assert rows(normalize.sky_rows(docs)) == [
        ("m", "BKN", None, "CB", 3), ("m", "FEW", 1000, None, 1), ("m", "OVC", 4000, None, 4)
    ]
    wide = normalize.sky_wide(docs).first()
    assert (wide["sky_condition_sky_cover1"], wide["sky_condition_cloud_base_ft_agl4"]) == ("FEW", 4000)


def test_airport_labels(spark):
    ref = spark.createDataFrame(
        [("CDG", "LFPG", "Charles de Gaulle International Airport", 0), ("XXX", "ZZZZ", "A Very Long Name Of A Place Intl", 1)],
        "code_iata string, icao_code string, name string, row_no long",
    )
    seen = spark.createDataFrame([("LFPG",), ("ZZZZ",), ("QQQQ",)], "station_id string")
    assert rows(reference.airport_labels(seen, ref)) == [
        ("LFPG", "Charles de Gaulle (LFPG/CDG)", "Charles de Gaulle"),
        ("QQQQ", "QQQQ", "QQQQ"),
        ("ZZZZ", "A Very Long Name Of A Place (ZZZZ/XXX)", "A Very Long Name O.."),
    ]
