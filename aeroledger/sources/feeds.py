"""METAR and TAF feeds (XML, plain or gzip) as documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SKY = "sky_condition array<struct<_sky_cover: string, _cloud_base_ft_agl: string, _cloud_type: string>>"

METAR_FIELDS = (
    "raw_text station_id observation_time latitude longitude temp_c dewpoint_c wind_dir_degrees wind_speed_kt "
    "wind_gust_kt visibility_statute_mi altim_in_hg sea_level_pressure_mb flight_category maxT_c minT_c metar_type "
    "pcp3hr_in pcp6hr_in pcp24hr_in precip_in three_hr_pressure_tendency_mb vert_vis_ft wx_string elevation_m"
).split()
TAF_FIELDS = (
    "raw_text station_id issue_time bulletin_time valid_time_from valid_time_to remarks latitude longitude elevation_m"
).split()
FORECAST_FIELDS = (
    "fcst_time_from fcst_time_to change_indicator probability wind_dir_degrees wind_speed_kt wind_gust_kt "
    "visibility_statute_mi altim_in_hg vert_vis_ft wx_string max_temp_c min_temp_c"
).split()

# Everything is read as text: feeds mix numbers with marks such as VRB or 6+.
METAR_SCHEMA = ", ".join(f"{f} string" for f in METAR_FIELDS) + ", " + SKY
TAF_SCHEMA = (
    ", ".join(f"{f} string" for f in TAF_FIELDS)
    + ", forecast array<struct<"
    + ", ".join(f"{f}: string" for f in FORECAST_FIELDS)
    + ", " + SKY.replace(" ", ": ", 1) + ">>"
)


def _layers(column: Column) -> Column:
    return F.transform(column, lambda layer: F.struct(
        layer["_sky_cover"].alias("sky_cover"), layer["_cloud_base_ft_agl"].alias("cloud_base_ft_agl"),
        layer["_cloud_type"].alias("cloud_type"),
    ))


def _any(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in columns])


def _filled(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])


def _metadata(kind: Column, file: Column, loaded_at: Column, fields: Column, source: str, index: Column) -> Column:
    return F.struct(
        F.lit(source).alias("source"), kind.alias("data_type"), loaded_at.alias("file_downloaded_at"),
        F.element_at(F.split(file, "/"), -1).alias("xml_file"), fields.alias("total_fields"),
        index.alias("forecast_index"),
    )


def metar_documents(
    reports: DataFrame, file: Column, loaded_at: Column, source: str = "metar-feed"
) -> DataFrame:
    """One document per report; empty elements are skipped.

    Without station or time the id is a hash of the report: unlike a running
    number it is the same on every read.
    """
    fields = [F.col(f) for f in METAR_FIELDS] + [F.col("sky_condition")]
    known = F.col("station_id").isNotNull() & F.col("observation_time").isNotNull()
    identity = F.when(known, F.concat_ws("_", "station_id", "observation_time")).otherwise(
        F.concat(F.lit("metar_"), F.hex(F.xxhash64(*[F.col(f) for f in METAR_FIELDS])))
    )
    return reports.filter(_any(fields)).select(
        identity.alias("_id"), *METAR_FIELDS, _layers(F.col("sky_condition")).alias("sky_condition"),
        _metadata(
            F.lit("METAR"), file, loaded_at, _filled(fields) + 1, source, F.lit(None).cast("int")
        ).alias("_metadata"),
    )


def taf_documents(
    reports: DataFrame, file: Column, loaded_at: Column, source: str = "taf-feed"
) -> DataFrame:
    """One document per forecast, or one base document for a report without any.

    An empty forecast among others gives no document but keeps its number.
    """
    base = [F.col(f) for f in TAF_FIELDS]
    forecasts = F.coalesce("forecast", F.array())
    parts = [f"item.{f}" for f in FORECAST_FIELDS]
    rows = reports.filter(_any(base) | (F.size(forecasts) > 0)).withColumn("file", file).select(
        *TAF_FIELDS, "file", F.size(forecasts).alias("n"), F.posexplode_outer("forecast").alias("index", "item")
    )
    has_forecast = _any([F.col(p) for p in parts] + [F.col("item.sky_condition")])
    lone = F.col("n") <= 1
    issued = F.coalesce("issue_time", "bulletin_time")
    suffix = F.when(has_forecast, F.concat(F.lit("f"), F.col("index"))).otherwise("base")
    start, stop = F.col("item.fcst_time_from"), F.col("item.fcst_time_to")
    identity = (
        F.when(F.col("station_id").isNull() | issued.isNull(), F.concat(
            F.lit("taf_"), F.hex(F.xxhash64(*base, *[F.col(p) for p in parts])), F.lit("_"), suffix
        ))
        .when(start.isNotNull(), F.concat_ws("_", "station_id", issued, start, stop, suffix))
        .otherwise(F.concat_ws("_", "station_id", issued, suffix))
    )
    filled = _filled(base) + _filled([F.col(p) for p in parts] + [F.col("item.sky_condition")]) + 1
    return rows.filter(has_forecast | lone).select(
        identity.alias("_id"), *TAF_FIELDS,
        *[F.col(f"item.{f}").alias(f"forecast_{f}") for f in FORECAST_FIELDS],
        _layers(F.col("item.sky_condition")).alias("forecast_sky_condition"),
        _metadata(
            F.when(has_forecast, "TAF_FORECAST").otherwise("TAF_BASE"), F.col("file"), loaded_at, filled,
            source, F.when(has_forecast, F.col("index")),
        ).alias("_metadata"),
    )


def read_metar(spark: SparkSession, path: str, loaded_at: Column | None = None) -> DataFrame:
    reports = spark.read.format("xml").option("rowTag", "METAR").schema(METAR_SCHEMA).load(path)
    return metar_documents(reports, F.col("_metadata.file_path"), F.current_timestamp() if loaded_at is None else loaded_at)


def read_taf(spark: SparkSession, path: str, loaded_at: Column | None = None) -> DataFrame:
    reports = spark.read.format("xml").option("rowTag", "TAF").schema(TAF_SCHEMA).load(path)
    return taf_documents(reports, F.col("_metadata.file_path"), F.current_timestamp() if loaded_at is None else loaded_at)


def _parsed(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Fields of the elements. The generator keeps one parse per element: a plain
    struct would be parsed again for every field that is read."""
    return rows.select(F.inline(F.array(F.from_xml(F.col(column), schema))))


def metar_from_text(rows: DataFrame, column: str, loaded_at: Column) -> DataFrame:
    """Documents from a column that holds one METAR element per row."""
    parsed = _parsed(rows, column, METAR_SCHEMA)
    return metar_documents(parsed, F.lit(column), loaded_at)


def taf_from_text(rows: DataFrame, column: str, loaded_at: Column) -> DataFrame:
    parsed = _parsed(rows, column, TAF_SCHEMA)
    return taf_documents(parsed, F.lit(column), loaded_at)


# ---- broken records ----------------------------------------------------------------

BROKEN = "_corrupt_record"


def read_checked(
    spark: SparkSession, path: str, kind: str, loaded_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents of a feed (``METAR`` or ``TAF``), and the elements that could not be read.

    The quarantine has ``file``, ``block_start`` (where the reading task began in the file) and ``record``, the
    element as it stands in the file. A file is cut behind every end tag, so a broken element takes none of its
    neighbours along, files are read in pieces, and an element without end tag is told from the one that follows it.
    """
    schema, shaped = (METAR_SCHEMA, metar_documents) if kind == "METAR" else (TAF_SCHEMA, taf_documents)
    end, start = f"</{kind}>", rf"<{kind}[\s>]"
    text = spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value"
    )
    # What is before the first start tag is no element; all but the last of several lack their end.
    cut = text.withColumn("pieces", F.filter(F.split("value", f"(?={start})"), lambda p: p.rlike(f"^{start}")))
    each = cut.select("file", "block_start", F.size("pieces").alias("of"), F.posexplode("pieces").alias("at", "piece"))
    whole = each.withColumn("record", F.when(F.col("at") + 1 == F.col("of"), F.concat("piece", F.lit(end))))
    parsed = F.from_xml("record", f"{schema}, {BROKEN} string", {"columnNameOfCorruptRecord": BROKEN, "mode": "PERMISSIVE"})
    found = whole.select("file", "block_start", "piece", "record", F.inline_outer(F.array(parsed)))
    broken = F.col("record").isNull() | F.col(BROKEN).isNotNull()
    good = shaped(found.filter(~broken), F.col("file"), F.current_timestamp() if loaded_at is None else loaded_at)
    bad = found.filter(broken).select("file", "block_start", F.coalesce("record", "piece").alias("record"))
    return good, bad
