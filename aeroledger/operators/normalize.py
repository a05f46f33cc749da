"""Documents into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_decimal, clean_integer, clean_timestamp


def _either(df: DataFrame, *names: str) -> Column:
    """First non-empty of the named columns that the documents have."""
    present = [F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def _attribute(df: DataFrame, name: str) -> Column:
    """A value stored as an XML attribute or as a plain element."""
    return _either(df, f"@{name}", name)


# ---- flight documents --------------------------------------------------------

def flight_id(number: Column, origin: Column, destination: Column, scheduled: Column) -> Column:
    """``number_from_to_YYYYMMDD_HHMM``; empty parts dropped, unknown time marked."""
    squeezed = F.replace(
        F.replace(F.regexp_replace(scheduled, "[-:]", ""), F.lit("T"), F.lit("_")), F.lit("Z"), F.lit("")
    )
    when = F.when(F.coalesce(scheduled, F.lit("")) == "", "UNKNOWN_TIME").otherwise(F.substring(squeezed, 1, 13))
    parts = [F.nullif(c, F.lit("")) for c in (number, origin, destination, when)]
    return F.concat_ws("_", *parts)


def collection_metadata(
    session_id: str, collection_type: str, collected_at: Column, source: str = "", version: str = "1.0"
) -> Column:
    return F.struct(
        F.lit(collection_type).alias("collection_type"), collected_at.alias("collected_at"),
        F.lit(source).alias("source"), F.lit(version).alias("script_version"),
        F.lit(session_id).alias("collection_session_id"), F.lit(False).alias("is_updated"),
        F.lit(0).alias("update_count"),
    )


def collected_flights(docs: DataFrame, session_id: str, collection_type: str, collected_at: Column) -> DataFrame:
    """Flight documents with their stable id and collection metadata."""
    return docs.withColumns({
        "_id": flight_id(
            F.col("flight_number"), F.col("from_code"), F.col("to_code"), F.col("departure.scheduled_utc")
        ),
        "_metadata": collection_metadata(session_id, collection_type, collected_at),
    })


def delay_minutes(later: Column, earlier: Column) -> Column:
    """Whole minutes, cut toward zero; early is negative; null if a time is missing."""
    gap = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return (gap / F.lit(60_000_000.0)).cast("int")


def late_minutes(later: Column, earlier: Column) -> Column:
    """The same, with early arrivals as 0."""
    minutes = delay_minutes(later, earlier)
    return F.when(minutes.isNotNull(), F.greatest(minutes, F.lit(0)))


def flight_rows(docs: DataFrame) -> DataFrame:
    """Flight documents as table rows; links by external id, keys filled later."""
    def text(path: str) -> Column:
        return F.col(path)

    has_actual = "actual_utc" in docs.schema["departure"].dataType.names
    actual = text("departure.actual_utc") if has_actual else F.lit(None).cast("string")
    links = {
        "departure_metar_external_id": "metar_id", "arrival_taf_external_id": "taf_id",
    }
    return docs.select(
        "flight_number",
        F.col("from_code").alias("from_airport"),
        F.col("to_code").alias("to_airport"),
        F.nullif(F.substring("flight_number", 1, 2), F.lit("")).alias("airline_code"),
        F.lit(None).cast("string").alias("aircraft_code"),
        *[
            (F.col(c) if c in docs.columns else F.lit(None).cast("string")).alias(name)
            for name, c in links.items()
        ],
        F.lit(None).cast("long").alias("departure_metar_fk"),
        F.lit(None).cast("long").alias("arrival_taf_fk"),
        clean_timestamp("departure.scheduled_utc").alias("departure_scheduled_utc"),
        clean_timestamp("departure.estimated_utc").alias("departure_actual_utc"),
        text("departure.terminal").alias("departure_terminal"),
        text("departure.gate").alias("departure_gate"),
        clean_timestamp("arrival.scheduled_utc").alias("arrival_scheduled_utc"),
        clean_timestamp("arrival.estimated_utc").alias("arrival_actual_utc"),
        text("arrival.terminal").alias("arrival_terminal"),
        text("arrival.gate").alias("arrival_gate"),
        "status",
        F.lit(None).cast("string").alias("status_final"),
        delay_minutes(clean_timestamp(actual), clean_timestamp("departure.scheduled_utc")).alias("delay_min"),
    )


def actual_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """Past-flight documents as late records for the flight table; ``keep`` passes columns on."""
    return docs.select(
        *keep,
        "flight_number", F.col("from_code").alias("from_airport"), F.col("to_code").alias("to_airport"),
        clean_timestamp("departure.scheduled_utc").alias("departure_scheduled_utc"),
        clean_timestamp("departure.estimated_utc").alias("departure_final_utc"),
        clean_timestamp("arrival.estimated_utc").alias("arrival_actual_utc"),
        F.col("status").alias("status_final"), F.col("arrival.delay.minutes").alias("delay_min"),
    )


# ---- weather documents -------------------------------------------------------

# Decimal columns as (name, places, precision, feed name).
METAR_DECIMALS = [
    ("temp_c", 2, 5, "temp_c"), ("dewpoint_c", 2, 5, "dewpoint_c"),
    ("visibility_statute_mi", 2, 5, "visibility_statute_mi"), ("altim_in_hg", 2, 5, "altim_in_hg"),
    ("sea_level_pressure_mb", 2, 6, "sea_level_pressure_mb"), ("maxt_c", 2, 5, "maxT_c"),
    ("mint_c", 2, 5, "minT_c"), ("pcp3hr_in", 3, 6, "pcp3hr_in"), ("pcp6hr_in", 3, 6, "pcp6hr_in"),
    ("pcp24hr_in", 3, 6, "pcp24hr_in"), ("precip_in", 3, 6, "precip_in"),
    ("three_hr_pressure_tendency_mb", 2, 6, "three_hr_pressure_tendency_mb"),
]


def metar_rows(docs: DataFrame) -> DataFrame:
    """METAR documents as table rows. Rows without id or station go to quarantine."""
    def whole(name: str, kind: str) -> Column:
        return clean_integer(_attribute(docs, name), kind).alias(name)

    return docs.select(
        F.col("_id").alias("external_id"),
        clean_timestamp(_attribute(docs, "observation_time")).alias("observation_time"),
        F.coalesce(_attribute(docs, "raw_text"), F.lit("")).alias("raw_text"),
        _attribute(docs, "station_id").alias("station_id"),
        clean_integer(_attribute(docs, "wind_dir_degrees")).cast("string").alias("wind_dir_degrees"),
        whole("wind_speed_kt", "short"), whole("wind_gust_kt", "short"),
        *[
            clean_decimal(_attribute(docs, feed), places, precision).alias(name)
            for name, places, precision, feed in METAR_DECIMALS
        ],
        _attribute(docs, "flight_category").alias("flight_category"),
        _attribute(docs, "metar_type").alias("metar_type"),
        whole("vert_vis_ft", "int"),
        _attribute(docs, "wx_string").alias("wx_string"),
    )


def taf_rows(docs: DataFrame) -> DataFrame:
    """TAF documents as table rows: report columns and one forecast's columns."""
    def forecast(name: str) -> Column:
        return _either(docs, f"forecast_@{name}", f"forecast_{name}")

    def number(name: str) -> Column:
        return clean_decimal(forecast(name)).alias(name)

    def whole(name: str, kind: str) -> Column:
        return clean_integer(forecast(name), kind).alias(name)

    return docs.select(
        F.col("_id").alias("external_id"),
        _attribute(docs, "station_id").alias("station_id"),
        *[
            clean_timestamp(_attribute(docs, c)).alias(c)
            for c in ("issue_time", "bulletin_time", "valid_time_from", "valid_time_to")
        ],
        _attribute(docs, "remarks").alias("remarks"),
        clean_timestamp(forecast("fcst_time_from")).alias("fcst_time_from"),
        clean_timestamp(forecast("fcst_time_to")).alias("fcst_time_to"),
        whole("wind_dir_degrees", "short"), whole("wind_speed_kt", "short"), whole("wind_gust_kt", "short"),
        number("visibility_statute_mi"), whole("vert_vis_ft", "int"),
        forecast("wx_string").alias("wx_string"), number("altim_in_hg"),
        forecast("change_indicator").alias("change_indicator"), whole("probability", "short"),
        number("max_temp_c"), number("min_temp_c"),
        F.coalesce(_attribute(docs, "raw_text"), F.lit("")).alias("raw_text"),
    )


# ---- sky layers --------------------------------------------------------------

SKY_LAYERS = 4


def sky_rows(docs: DataFrame, column: str = "sky_condition", parent: str = "_id") -> DataFrame:
    """One row per sky layer: first four, numbered by place, empty covers dropped."""
    layers = docs.select(
        F.col(parent).alias("external_id"), F.posexplode(F.slice(column, 1, SKY_LAYERS)).alias("place", "layer")
    )
    return layers.filter(F.coalesce("layer.sky_cover", F.lit("")) != "").select(
        "external_id", F.col("layer.sky_cover").alias("sky_cover"),
        clean_integer("layer.cloud_base_ft_agl").alias("cloud_base_ft_agl"),
        F.col("layer.cloud_type").alias("cloud_type"),
        (F.col("place") + 1).cast("short").alias("condition_order"),
    )


def sky_wide(docs: DataFrame, column: str = "sky_condition", parent: str = "_id") -> DataFrame:
    """Cover and base of the first four layers as eight columns."""
    wide = []
    for i in range(SKY_LAYERS):
        layer = F.get(F.col(column), i)
        wide.append(layer["sky_cover"].alias(f"sky_condition_sky_cover{i + 1}"))
        wide.append(clean_integer(layer["cloud_base_ft_agl"]).alias(f"sky_condition_cloud_base_ft_agl{i + 1}"))
    return docs.select(F.col(parent).alias("external_id"), *wide)

