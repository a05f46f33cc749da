"""Features for delay prediction, from the wide flight view."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import minutes_between
from ..functions.weather import IMPACT_MARKS, impact_marks, impact_of, impact_text, worst_impact
from ..functions.zones import utc_to_local, zone_lookup
from ..operators.sizing import MAX_LOOKUP_BYTES, ROW_BYTES, sized_broadcast
from ..session import compiled_steps, reliable_checkpoint

DEPARTURE, ARRIVAL = "departure_scheduled_utc", "arrival_scheduled_utc"

# Model features by kind, and the orders of the ordered ones.
NUMERIC = [
    "wind_speed_kt", "wind_dir_degrees", "wind_gust_kt",
    "t_wind_speed_kt", "t_wind_dir_degrees", "t_wind_gust_kt",
    "departure_delay_minutes", "flight_duration_minutes", "airport_flight_count", "airline_flight_count",
    "weather_severity_dep", "weather_severity_arr", "flight_duration_hours",
    "departure_hour_local", "arrival_hour_local", "departure_dayofweek", "arrival_dayofweek",
    "departure_month", "departure_quarter", "departure_day",
    "is_rush_hour_dep", "is_rush_hour_arr", "is_weekend", "is_month_end", "is_month_start",
    "dep_has_convective", "dep_has_icing", "dep_visibility_affected", "dep_wind_affected",
    "arr_has_convective", "arr_has_icing", "arr_visibility_affected", "arr_wind_affected",
]
CATEGORICAL = [
    "dep_weather_simplified", "arr_weather_simplified",
    "dep_weather_impact", "arr_weather_impact", "overall_weather_impact",
]
ORDERED = ["visibility_statute_mi", "t_visibility_statute_mi", "msc_sky_cover", "tsc_sky_cover"]
VISIBILITY_ORDER = ["<1", "<2", "<3", "<4", "<5", ">=5"]
SKY_COVER_ORDER = ["SKC", "CAVOK", "CLR", "OVX", "FEW", "SCT", "BKN", "OVC"]

# All that a model reads from a feature frame, beside the key.
MODEL_COLUMNS = ["delay", *NUMERIC, *CATEGORICAL, *ORDERED]

# Columns read from the view.
VIEW_COLUMNS = [
    "airline_code", "from_airport", "to_airport", "status", "status_final", "delay_min",
    "departure_scheduled_utc", "departure_actual_utc", "arrival_scheduled_utc",
    "wind_speed_kt", "wind_dir_degrees", "wind_gust_kt", "visibility_statute_mi", "msc_sky_cover", "wx_string",
    "t_wind_speed_kt", "t_wind_dir_degrees", "t_wind_gust_kt", "t_visibility_statute_mi", "tsc_sky_cover",
    "t_wx_string",
]
TIMES = ["departure_scheduled_utc", "departure_actual_utc", "arrival_scheduled_utc"]
NUMBERS = [
    "visibility_statute_mi", "t_visibility_statute_mi", "wind_speed_kt", "wind_gust_kt", "t_wind_speed_kt",
    "t_wind_gust_kt", "wind_dir_degrees", "t_wind_dir_degrees", "delay_min",
]
# Columns whose relative frequency is a feature.
FREQUENCIES = {"from_airport": "airport_flight_count", "airline_code": "airline_flight_count"}

# Local rush hours.
RUSH_HOURS = [7, 8, 17, 18, 19]


def typed(df: DataFrame) -> DataFrame:
    """Times and numbers of a view or CSV export; unreadable values become null."""
    present = [c for c in TIMES + NUMBERS if c in df.columns]
    return df.withColumns({
        c: F.col(c).try_cast("timestamp_ntz" if c in TIMES else "double") for c in present
    })


# ---- cleaning ----------------------------------------------------------------

def remove_gaps(df: DataFrame) -> DataFrame:
    """Drop every departure hour in which no flight has a usable final status.

    The hours with one are a small table; the flights are not shuffled for it.
    """
    dated = df.filter(F.col(DEPARTURE).isNotNull())
    usable = (F.trim("status_final") != "") & (F.lower("status_final") != "null")
    hour = F.date_trunc("hour", DEPARTURE)
    covered = dated.filter(usable).select(hour.alias("covered_hour")).distinct()
    return dated.join(sized_broadcast(covered), hour == F.col("covered_hour"), "left_semi")


def settled(df: DataFrame, hours: int = 24) -> DataFrame:
    """Only departures before the newest one minus ``hours``: later ones may still change."""
    newest = df.agg(F.max(DEPARTURE).alias("newest")).scalar()
    return df.filter(F.col(DEPARTURE) < newest - F.expr(f"interval {hours} hours"))


@dataclass(frozen=True)
class TrainingCut:
    """What training keeps, taken from the flight table alone.

    ``hours``: departure hours with a usable final status; ``before``: departures must
    be earlier; ``tables``: frequencies among the flights that both leave.
    """

    hours: DataFrame
    before: dt.datetime | None
    tables: dict[str, DataFrame]


def training_cut(flights: DataFrame, hours: int = 24) -> TrainingCut:
    """Covered hours, newest departure and frequencies from one pass over the flights.

    Flights are counted per hour and combination of the frequency columns. Only the hour
    that the cut falls into is read again, for the flights before the cut.
    """
    columns = list(FREQUENCIES)
    dated = typed(flights.select(DEPARTURE, "status_final", *columns)).filter(F.col(DEPARTURE).isNotNull())
    usable = (F.trim("status_final") != "") & (F.lower("status_final") != "null")
    hour = F.date_trunc("hour", DEPARTURE).cast("timestamp_ntz")
    counted = reliable_checkpoint(dated.groupBy(hour.alias("hour"), *columns).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.coalesce(usable, F.lit(False))).alias("usable"), F.max(DEPARTURE).alias("newest"),
    ))
    by_hour = counted.groupBy("hour").agg(F.max("usable").alias("usable"), F.max("newest").alias("newest")).filter("usable")
    # Two moments a row, so the number of rows tells the size, in the same job as the newest departure.
    hours_kept = reliable_checkpoint(by_hour.select("hour", "newest"))
    newest, size = hours_kept.agg(F.max("newest"), F.count(F.lit(1))).first()
    covered = F.broadcast(hours_kept) if size * 2 * ROW_BYTES <= MAX_LOOKUP_BYTES else hours_kept
    before = newest and newest - dt.timedelta(hours=hours)
    edge = before and before.replace(minute=0, second=0, microsecond=0)
    whole = counted.filter(F.col("hour") < F.lit(edge).cast("timestamp_ntz")).select("hour", *columns, "rows")
    part = dated.filter(
        (F.col(DEPARTURE) >= F.lit(edge).cast("timestamp_ntz")) & (F.col(DEPARTURE) < F.lit(before).cast("timestamp_ntz"))
    ).groupBy(hour.alias("hour"), *columns).agg(F.count(F.lit(1)).alias("rows"))
    kept = whole.unionByName(part).join(covered.select("hour"), "hour", "left_semi")
    return TrainingCut(covered.select("hour"), before, _shares(kept, columns))


# ---- frequencies -------------------------------------------------------------

def frequency_tables(df: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """Per column the share of each value among the rows that have one, from one pass.

    The counts per value of all columns are written once; totals and sizes are sums over them, so no step
    gathers all values in one task.
    """
    return _shares(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")), columns)


class Shares(dict):
    """Frequency tables that were measured together: those that are small carry a broadcast hint."""


def _shares(counts: DataFrame, columns: list[str]) -> Shares:
    """Shares from ``rows`` per combination of the columns' values."""
    each = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).alias("value"), F.col("rows")) for c in columns
    ]))).filter("value is not null")
    known = reliable_checkpoint(each.groupBy("name", "value").agg(F.sum("rows").alias("n")))
    # One row per column.
    totals = {r["name"]: r for r in known.groupBy("name").agg(
        F.sum("n").alias("n"), (F.sum(F.octet_length("value")) + F.count(F.lit(1)) * 2 * ROW_BYTES).alias("bytes")
    ).collect()}
    tables = Shares()
    for column in columns:
        total, size = (totals[column]["n"], totals[column]["bytes"]) if column in totals else (1, 0)
        own = known.filter(F.col("name") == column).select(F.col("value").alias(column), (F.col("n") / F.lit(total)).alias("share"))
        tables[column] = F.broadcast(own) if size <= MAX_LOOKUP_BYTES else own
    return tables


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return frequency_tables(df, [column])[column]


def with_frequency(df: DataFrame, table: DataFrame, column: str, out: str, measured: bool = False) -> DataFrame:
    """Add a stored frequency; a value the table does not know gets null. A table that was not ``measured`` is now."""
    known = table.select(column, F.col("share").alias(out))
    return df.join(known if measured else sized_broadcast(known), column, "left")


# ---- weather -----------------------------------------------------------------

def visibility_class(miles: Column) -> Column:
    label = F.lit(VISIBILITY_ORDER[-1])
    for limit in range(5, 0, -1):
        label = F.when(miles < limit, f"<{limit}").otherwise(label)
    return F.when(miles.isNotNull(), label)


def severity(wind: Column, gust: Column, visibility: Column) -> Column:
    """0 to 3: strong wind, strong gust, visibility class below two miles."""
    def point(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    return point(wind > 20) + point(gust > 30) + point(visibility.isin("<1", "<2"))


def weather_features(df: DataFrame) -> DataFrame:
    calm = ["wind_speed_kt", "t_wind_speed_kt", "wind_gust_kt", "t_wind_gust_kt"]
    df = df.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in calm}).withColumns({
        c: visibility_class(F.col(c)) for c in ("visibility_statute_mi", "t_visibility_statute_mi")
    })
    # Texts, then what they hold, then what follows: each is worked out once, in steps small enough to be compiled.
    ends = {"dep": "wx_string", "arr": "t_wx_string"}
    df = df.withColumns({f"_{end}_text": impact_text(F.col(column)) for end, column in ends.items()})
    df = df.withColumns({
        f"_{end}_{name}": value for end in ends for name, value in impact_marks(F.col(f"_{end}_text")).items()
    })
    parts = {}
    for end in ends:
        marks = {name: F.col(f"_{end}_{name}") for name in IMPACT_MARKS}
        parts.update({f"{end}_{name}": value for name, value in impact_of(marks).items()})
    out = df.withColumns({
        "weather_severity_dep": severity(
            F.col("wind_speed_kt"), F.col("wind_gust_kt"), F.col("visibility_statute_mi")
        ),
        "weather_severity_arr": severity(
            F.col("t_wind_speed_kt"), F.col("t_wind_gust_kt"), F.col("t_visibility_statute_mi")
        ),
        **parts,
    }).withColumn(
        "overall_weather_impact", worst_impact(F.col("dep_weather_impact"), F.col("arr_weather_impact"))
    )
    return out.drop(*[f"_{end}_{name}" for end in ends for name in ("text", *IMPACT_MARKS)])


# ---- time --------------------------------------------------------------------

def flag(condition: Column) -> Column:
    """1 or 0; unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def time_features(df: DataFrame, airports: DataFrame) -> DataFrame:
    zones = zone_lookup(airports, "code", "zone")
    for end, name in (("from_airport", "departure_timezone"), ("to_airport", "arrival_timezone")):
        df = df.join(zones.toDF(end, name), end, "left")
    df = df.withColumns({
        "departure_scheduled_local": utc_to_local(F.col(DEPARTURE), F.col("departure_timezone")),
        "arrival_scheduled_local": utc_to_local(F.col(ARRIVAL), F.col("arrival_timezone")),
    })
    leave, arrive = F.col("departure_scheduled_local"), F.col("arrival_scheduled_local")
    return df.withColumns({
        "departure_hour_local": F.hour(leave),
        "arrival_hour_local": F.hour(arrive),
        "departure_dayofweek": F.weekday(leave),
        "arrival_dayofweek": F.weekday(arrive),
        "departure_month": F.month(leave),
        "departure_quarter": F.quarter(leave),
        "departure_day": F.dayofmonth(leave),
        "flight_duration_hours": F.bround(minutes_between(ARRIVAL, DEPARTURE) / 60.0, 1),
        "is_rush_hour_dep": flag(F.hour(leave).isin(RUSH_HOURS)),
        "is_rush_hour_arr": flag(F.hour(arrive).isin(RUSH_HOURS)),
        "is_weekend": flag(F.weekday(leave) >= 5),
        "is_month_end": flag(F.dayofmonth(leave) > 25),
        "is_month_start": flag(F.dayofmonth(leave) <= 5),
    })


# ---- target and sample -------------------------------------------------------

def target(df: DataFrame, threshold: int = 15) -> DataFrame:
    """Late if the delay is above the threshold; an unknown delay counts as none."""
    minutes = F.coalesce("delay_min", F.lit(0.0))
    return df.withColumns({"delay_min": minutes, "delay": (minutes > threshold).cast("int")})


def class_shares(df: DataFrame, label: str = "delay") -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(W.partitionBy())).orderBy(label)


BUCKET_BITS = 16
HASH_BITS = 60


def key_hash(key: list[str], seed: int) -> Column:
    """60 bits of an MD5 over seed and key: the same number in every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def ranked(df: DataFrame, key: list[str], seed: int, label: str) -> DataFrame:
    """Rows with ``_rank`` (from 1, by key hash) and ``_n`` within their label.

    Rows are counted per label and hash bucket, so no task orders a whole label.
    """
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn(
        "_bucket", F.shiftrightunsigned(F.col("_h"), HASH_BITS - BUCKET_BITS)
    ).withColumn("_label", F.coalesce(F.col(label).cast("long"), F.lit(-1)))
    counts = hashed.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_in_bucket"))
    # At most 2**16 rows per label, by construction.
    ahead = W.partitionBy("_label").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        "_label", "_bucket", F.coalesce(F.sum("_in_bucket").over(ahead), F.lit(0)).alias("_ahead"),
        F.sum("_in_bucket").over(W.partitionBy("_label")).alias("_n"),
    )
    inside = F.row_number().over(W.partitionBy("_label", "_bucket").orderBy("_h", *key))
    placed = hashed.withColumn("_inside", inside).join(sized_broadcast(counts), ["_label", "_bucket"])
    return placed.withColumn("_rank", F.col("_ahead") + F.col("_inside")).select(*df.columns, "_rank", "_n")


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all), the same on every run: those with the smallest key hashes.

    Hash buckets are counted first, so no task sorts the whole table: buckets
    below the cut pass whole and only the bucket at the cut is ordered.
    """
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn(
        "_bucket", F.shiftrightunsigned(F.col("_h"), HASH_BITS - BUCKET_BITS)
    )
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 2**16 rows, by construction.
    before = F.sum("_n").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    cut = counts.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < n)
    placed = hashed.join(F.broadcast(cut), "_bucket")
    whole = placed.filter(F.col("_before") + F.col("_n") <= n)
    edge = placed.filter(F.col("_before") + F.col("_n") > n).withColumn(
        "_place", F.row_number().over(W.partitionBy("_bucket").orderBy("_h", *key))
    ).filter(F.col("_before") + F.col("_place") <= n).drop("_place")
    return whole.unionByName(edge).select(*df.columns)


# ---- the whole step ----------------------------------------------------------

def prepare(
    view: DataFrame, airports: DataFrame, for_training: bool = True, threshold: int = 15,
    tables: dict[str, DataFrame] | None = None, key: str = "f_id", cut: TrainingCut | None = None,
) -> DataFrame:
    """All features of the view's flights, and the target when training.

    ``tables`` holds stored airport and airline frequencies; without them they
    come from the frame itself, after the 24-hour cut and before cancelled
    flights go. With ``cut`` (``training_cut`` of the flight table) hours, newest departure
    and frequencies are known beforehand, and the view is computed once, for the
    flights that stay.
    """
    compiled_steps(view.sparkSession)
    kept = [key] if key in view.columns else []
    df = typed(view.select(*kept, *VIEW_COLUMNS))
    if for_training and cut:
        df = df.filter(F.col(DEPARTURE) < F.lit(cut.before).cast("timestamp_ntz"))
        hour = F.date_trunc("hour", DEPARTURE).cast("timestamp_ntz")
        df = df.join(cut.hours, hour == F.col("hour"), "left_semi")
        tables = tables or cut.tables
    elif for_training:
        df = settled(remove_gaps(df))
    if tables is None:
        tables = frequency_tables(df, list(FREQUENCIES))
    for column, out in FREQUENCIES.items():
        df = with_frequency(df, tables[column], column, out, isinstance(tables, Shares))
    df = df.withColumns({
        "departure_delay_minutes": minutes_between("departure_actual_utc", DEPARTURE),
        "flight_duration_minutes": minutes_between(ARRIVAL, DEPARTURE),
    })
    if for_training:
        df = df.filter(F.coalesce(F.col("status") != "CANCELLED", F.lit(True)))
    df = time_features(weather_features(df), airports)
    return target(df, threshold) if for_training else df
