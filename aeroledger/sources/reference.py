"""Reference files and fixed reference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Sky cover codes as (code, description, description_en, octal_min,
# octal_max, percentage_min, percentage_max, is_special_code, sort_order, notes).
SKY_COVER = [
    ("FEW", "Peu de nuages", "Few clouds", "1.0", "2.0", 12, 25, False, 1,
     "Couverture nuageuse de 1/8 à 2/8"),
    ("SCT", "Nuages épars", "Scattered clouds", "3.0", "4.0", 37, 50, False, 2,
     "Couverture nuageuse de 3/8 à 4/8"),
    ("BKN", "Ciel fragmenté", "Broken clouds", "5.0", "7.0", 62, 87, False, 3,
     "Couverture nuageuse de 5/8 à 7/8"),
    ("OVC", "Ciel couvert", "Overcast clouds", "8.0", "8.0", 100, 100, False, 4,
     "Couverture nuageuse complète 8/8"),
    ("NSC", "Pas de nuages significatifs", "No significant cloud cover", None, None, None, None, True, 10,
     "Aucun nuage en dessous de 5000 ft, mais présence possible au-dessus (non CB/TCU)"),
    ("SKC", "Ciel dégagé", "Sky clear", "0.0", "0.0", 0, 0, True, 11,
     "Aucune couverture nuageuse (déterminé par météorologue)"),
    ("NCD", "Nuages non détectés", "No clouds detected", None, None, None, None, True, 12,
     "Aucun nuage mesuré (stations météo automatiques)"),
    ("CLR", "Ciel dégagé détecté", "Clear sky detected", "0.0", "0.0", 0, 0, True, 13,
     "Aucune couverture nuageuse détectée en dessous de 12000 ft (stations automatiques)"),
    ("VV", "Visibilité verticale", "Vertical visibility", None, None, None, None, True, 20,
     "Visibilité verticale obscurcie, base nuageuse impossible à établir"),
]

# IATA code, ICAO code and time zone of the airports used when there is no reference file.
FALLBACK_ZONES = [
    ("CDG", "LFPG", "Europe/Paris"),
    ("ORY", "LFPO", "Europe/Paris"),
    ("LHR", "EGLL", "Europe/London"),
    ("JFK", "KJFK", "America/New_York"),
    ("LAX", "KLAX", "America/Los_Angeles"),
    ("NRT", "RJAA", "Asia/Tokyo"),
    ("DXB", "OMDB", "Asia/Dubai"),
    ("SIN", "WSSS", "Asia/Singapore"),
    ("FRA", "EDDF", "Europe/Berlin"),
    ("AMS", "EHAM", "Europe/Amsterdam"),
]

# Headers of the header-less public route, airline and airport files.
HEADERS = {
    "airlines": "id,name,alias,iata,icao,callsign,country_name,active",
    "airports": "id,name,city,country,iata_code,icao_code,latitude,longitude,altitude,gmt_offset,dst,"
                "timezone,airporttype,source",
    "routes": "airline_iata,airline_id,source_airport_iata,source_airport_id,dest_airport_iata,"
              "dest_airport_id,shared,stops,equipments",
    "planes": "name,iata_code,icao_code",
}


def sky_cover_reference(spark: SparkSession) -> DataFrame:
    """The nine sky cover codes."""
    rows = [(i, *row) for i, row in enumerate(SKY_COVER, start=1)]
    names = (
        "id long, code string, description string, description_en string, octal_min string, "
        "octal_max string, percentage_min int, percentage_max int, is_special_code boolean, "
        "sort_order int, notes string"
    )
    return spark.createDataFrame(rows, names).withColumns({
        "octal_min": F.col("octal_min").cast("decimal(2,1)"),
        "octal_max": F.col("octal_max").cast("decimal(2,1)"),
    })


def fallback_airports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FALLBACK_ZONES, "code_iata string, icao_code string, timezone string")


def airport_reference(spark: SparkSession, path: str) -> DataFrame:
    """``;``-separated airport reference: trimmed, blank codes dropped, last copy kept.

    ``row_no`` is the line's place: the file (a few thousand lines) is read whole, so
    "the first N airports" does not depend on splits; files follow each other by name.
    """
    header = spark.read.csv(path, sep=";", header=True, encoding="UTF-8").columns
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = files.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "text")).filter(
        "line > 0 and trim(text) <> ''"
    )
    schema = ", ".join(f"`{c}` string" for c in header)
    parsed = lines.select("file", "line", F.from_csv("text", F.lit(schema), {"sep": ";"}).alias("row"))
    first = parsed.groupBy("file").agg((F.max("line") + 1).alias("lines"))
    ahead = F.coalesce(F.sum("lines").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # One row per file of the reference.
    placed = parsed.join(F.broadcast(first.withColumn("ahead", ahead)), "file")
    clean = placed.select(
        *[F.trim(F.col(f"row.{c}")).alias(c) for c in header], (F.col("ahead") + F.col("line")).alias("row_no")
    )
    return last_per_code(clean)


def last_per_code(rows: DataFrame) -> DataFrame:
    """Last row of each ``code_iata`` by ``row_no``; a row without a code is dropped."""
    named = rows.filter(F.coalesce("code_iata", F.lit("")) != "")
    latest = named.groupBy("code_iata").agg(
        F.max_by(F.struct(*[c for c in named.columns if c != "code_iata"]), "row_no").alias("row")
    )
    return latest.select("code_iata", "row.*")


def airport_reference_or_fallback(spark: SparkSession, path: str) -> DataFrame:
    """The reference file, or the ten built-in airports if it is absent; a broken file is an error."""
    from pyspark.errors import AnalysisException

    try:
        return airport_reference(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback_airports(spark)


def first_airports(reference: DataFrame, n: int) -> DataFrame:
    """First ``n`` airports in file order."""
    return reference.orderBy("row_no").limit(n)


def headerless_csv(spark: SparkSession, path: str, kind: str, null_marker: str = "\\N") -> DataFrame:
    """A public CSV without header line; a repeated header row is dropped.

    The null marker becomes null. ``NA`` stays text: it is a country code.
    """
    names = HEADERS[kind].split(",")
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = spark.read.csv(path, schema=schema, header=False, nullValue=null_marker, encoding="UTF-8")
    is_header = F.lit(True)
    for name in names:
        is_header = is_header & F.coalesce(F.col(name) == name, F.lit(False))
    return rows.filter(~is_header)


def seed_csv(spark: SparkSession, path: str, schema: str, null_marker: str = "") -> DataFrame:
    """A seed file with header and declared types; ``NA`` stays text."""
    return spark.read.csv(path, schema=schema, header=True, nullValue=null_marker, encoding="UTF-8")


def load_seed(spark: SparkSession, path: str, schema: str, target_dir: str) -> str:
    """Replace the table named after the seed file and return its folder."""
    name = path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")
    target = f"{target_dir.rstrip('/')}/{name}"
    seed_csv(spark, path, schema).write.mode("overwrite").parquet(target)
    return target


# Tables of a full restore, parents before children.
RESTORE_ORDER = ["sky_cover_reference", "metar", "taf", "sky_condition", "flight"]


def restore_tables(spark: SparkSession, files: dict[str, str], schemas: dict[str, str], target_dir: str) -> dict[str, str]:
    """Replace the five tables from (gzip) CSV exports; keys are checked afterwards."""
    done = {}
    for name in RESTORE_ORDER:
        if name not in files:
            continue
        target = f"{target_dir.rstrip('/')}/{name}"
        rows = spark.read.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(
            files[name], schema=schemas[name], header=True, nullValue=""
        )
        rows.write.mode("overwrite").parquet(target)
        done[name] = target
    return done


# ---- paged reference JSON ----------------------------------------------------

# Where each resource keeps its list, and its flat columns.
PAGED = {
    "countries": ("CountryResource.Countries.Country", "CountryCode: string, Names: struct<Name: struct<`$`: string>>",
                  {"CountryCode": "CountryCode", "Name": "Names.Name.`$`"}),
    "cities": ("CityResource.Cities.City",
               "CityCode: string, CountryCode: string, Names: struct<Name: struct<`$`: string>>",
               {"CityCode": "CityCode", "CountryCode": "CountryCode", "Name": "Names.Name.`$`"}),
    "airports": ("AirportResource.Airports.Airport",
                 "AirportCode: string, CityCode: string, CountryCode: string, "
                 "Names: struct<Name: struct<`$`: string>>, "
                 "Position: struct<Coordinate: struct<Latitude: double, Longitude: double>>, "
                 "UtcOffset: string, TimeZoneId: string",
                 {"AirportCode": "AirportCode", "CityCode": "CityCode", "CountryCode": "CountryCode",
                  "Name": "Names.Name.`$`", "Latitude": "Position.Coordinate.Latitude",
                  "Longitude": "Position.Coordinate.Longitude", "UtcOffset": "UtcOffset",
                  "TimeZoneId": "TimeZoneId"}),
    "airlines": ("AirlineResource.Airlines.Airline",
                 "AirlineID: string, AirlineID_ICAO: string, Names: struct<Name: struct<`$`: string>>",
                 {"AirlineID": "AirlineID", "AirlineID_ICAO": "AirlineID_ICAO", "Name": "Names.Name.`$`"}),
    "aircraft": ("AircraftResource.AircraftSummaries.AircraftSummary",
                 "AircraftCode: string, Names: struct<Name: struct<`$`: string>>, AirlineEquipCode: string",
                 {"AircraftCode": "AircraftCode", "Name": "Names.Name.`$`",
                  "AirlineEquipCode": "AirlineEquipCode"}),
}


def paged_schema(kind: str) -> str:
    """Schema of one page: nested structs down to the list of items."""
    path, item, _ = PAGED[kind]
    nested = f"array<struct<{item}>>"
    for name in reversed(path.split(".")[1:]):
        nested = f"struct<{name}: {nested}>"
    return f"{path.split('.')[0]} {nested}"


def flatten_pages(pages: DataFrame, kind: str) -> DataFrame:
    """One flat row per item of all pages."""
    path, _, columns = PAGED[kind]
    items = pages.select(F.explode(F.col(path)).alias("item"))
    return items.select(*[F.col(f"item.{source}").alias(name) for name, source in columns.items()])


def paged_reference(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Landed reference pages as flat rows; no page order is needed."""
    return flatten_pages(spark.read.schema(paged_schema(kind)).json(path, multiLine=True), kind)


def airport_labels(stations: DataFrame, reference: DataFrame, station: str = "station_id") -> DataFrame:
    """Add ``label`` and ``short`` for an ICAO code; unknown codes show themselves."""
    # Suffixes removed from airport names, in this order.
    suffixes = [" International Airport", " Airport", " Intl"]
    short = F.col("name")
    for suffix in suffixes:
        short = F.replace(short, F.lit(suffix), F.lit(""))
    known = (
        reference.select(
            F.trim("icao_code").alias(station), F.trim("name").alias("name"),
            F.coalesce(F.trim("code_iata"), F.lit("")).alias("iata"), "row_no",
        )
        .filter(f"{station} <> '' and name <> ''")
        .groupBy(station).agg(F.max_by(F.struct("name", "iata"), "row_no").alias("row"))
        .select(station, "row.*")
        .withColumn("short_name", F.trim(short))
    )
    tail = F.when(F.col("iata") != "", F.concat(F.lit("/"), "iata")).otherwise("")
    return stations.join(known, station, "left").select(
        *stations.columns,
        F.coalesce(
            F.concat("short_name", F.lit(" ("), F.col(station), tail, F.lit(")")), F.col(station)
        ).alias("label"),
        F.coalesce(
            F.when(F.length("short_name") > 20, F.concat(F.substring("short_name", 1, 18), F.lit("..")))
            .otherwise(F.col("short_name")),
            F.col(station),
        ).alias("short"),
    )
