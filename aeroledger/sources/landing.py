"""The landing zone: which board files are there, how old, and which to use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name of a landed board file, and its longest accepted age.
NAME_PATTERN = r"^raw_([A-Z]{3})_(arrival|departure)_(\d{4}-\d{2}-\d{2})_(\d{2})h_(\d{8}_\d{6})\.html$"
MAX_AGE_HOURS = 24


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, time and size of landed files; the contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "raw_*.html").load(folder)
        .select("path", F.col("modificationTime").cast("timestamp_ntz").alias("modified"), "length")
    )


def catalog(
    listing: DataFrame, now: Column, airport: str | None = None, date: str | None = None,
    board_type: str | None = None,
) -> DataFrame:
    """Files whose name is a board name, with its parts and age, optionally filtered."""
    name = F.element_at(F.split("path", "/"), -1)
    seconds = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("modified").cast("timestamp"))) / 1e6
    files = listing.withColumn("filename", name).filter(F.col("filename").rlike(NAME_PATTERN)).select(
        "path", "filename",
        *[
            F.regexp_extract("filename", NAME_PATTERN, i).alias(part)
            for i, part in enumerate(("airport", "type", "date", "shift", "timestamp"), start=1)
        ],
        F.col("length").alias("size"), "modified", seconds.alias("age_seconds"),
        F.round(seconds / 3600, 1).alias("age_hours"),
    )
    if airport:
        files = files.filter(F.col("airport") == airport.upper())
    if date:
        files = files.filter(F.col("date") == date)
    if board_type:
        files = files.filter(F.col("type") == board_type)
    return files


def newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.desc("timestamp"), "filename")


def totals(files: DataFrame) -> DataFrame:
    """Number of files, airports and dates, and the age of the oldest and newest."""
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.countDistinct("airport").alias("airports"),
        F.countDistinct("date").alias("dates"),
        F.coalesce(F.max("age_hours"), F.lit(0.0)).alias("oldest_file_age_hours"),
        F.coalesce(F.min("age_hours"), F.lit(0.0)).alias("newest_file_age_hours"),
    )


KEY = ["airport", "type", "date", "shift"]


def newest_per_key(files: DataFrame, max_age_hours: float = MAX_AGE_HOURS) -> DataFrame:
    """Newest file of each key; keys whose newest file is too old are left out."""
    newest = files.groupBy(*KEY).agg(
        F.max(F.struct("modified", "filename", "path", "age_seconds")).alias("newest")
    ).select(*KEY, "newest.*")
    return newest.filter(F.col("age_seconds") <= max_age_hours * 3600)


def lookup(files: DataFrame, wanted: DataFrame, max_age_hours: float = MAX_AGE_HOURS) -> DataFrame:
    """Newest file of each wanted board with what became of the request.

    ``status`` is ``found``, ``too old`` (with the file and its age) or ``missing``: a stale
    board is refused and the caller is told, nothing is left out.
    """
    newest = files.groupBy(*KEY).agg(
        F.max(F.struct("modified", "filename", "path", "age_seconds")).alias("newest")
    ).select(*KEY, "newest.*")
    status = (
        F.when(F.col("path").isNull(), "missing").when(F.col("age_seconds") > max_age_hours * 3600, "too old")
        .otherwise("found")
    )
    return wanted.select(*KEY).distinct().join(newest, KEY, "left").select(
        *KEY, status.alias("status"), "filename", F.when(status == "found", F.col("path")).alias("path"), "age_seconds"
    )


def expired(files: DataFrame, max_age_hours: float) -> DataFrame:
    """Files past retention; deleting them is left to the storage."""
    return files.filter(F.col("age_hours") > max_age_hours).select("path", "filename", "age_hours")


def missing_boards(expected: DataFrame, files: DataFrame, board_type: str = "departure") -> DataFrame:
    """Expected (airport, date, hour) boards that have not landed."""
    landed = files.filter(F.col("type") == board_type).select(
        F.col("airport").alias("iata_code"), F.col("date").alias("board_date"), "shift"
    )
    return expected.join(landed, ["iata_code", "board_date", "shift"], "left_anti")
