"""JSON and CSV documents in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

# Fixed value: name of a combined flight file.
COMBINED_NAME = r"^combined_([a-z]+)_(\d{4}-\d{2}-\d{2})\.json$"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file that holds one object or a list of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def _provenance(loaded_at: Column, **more: Column) -> Column:
    return F.struct(
        F.col("_metadata.file_name").alias("source_file"), loaded_at.alias("imported_at"),
        F.col("_metadata.file_path").alias("file_path"),
        *[value.alias(name) for name, value in more.items()],
    )


def read_json_with_provenance(
    spark: SparkSession, path: str, schema: str, loaded_at: Column | None = None
) -> DataFrame:
    """Documents with the file they came from and when they were read."""
    rows = read_json(spark, path, schema)
    return rows.withColumn("provenance", _provenance(F.current_timestamp() if loaded_at is None else loaded_at))


BROKEN = "_corrupt_record"


def read_json_checked(
    spark: SparkSession, path: str, schema: str, lines: bool = False, loaded_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents with provenance, and what could not be read: ``file`` and ``record``.

    With ``lines`` every line is a document and only the broken line is lost, else a broken file is one record.
    """
    marked, file = f"{schema}, {BROKEN} string", F.col("_metadata.file_path").alias("file")
    when = F.current_timestamp() if loaded_at is None else loaded_at
    if lines:
        text = spark.read.text(path).filter(F.trim("value") != "")
        parsed = F.from_json("value", marked, {"columnNameOfCorruptRecord": BROKEN})
        found = text.select(file, F.col("_metadata.file_name").alias("file_name"), "value", F.inline(F.array(parsed)))
        source = F.struct(F.col("file_name").alias("source_file"), when.alias("imported_at"), F.col("file").alias("file_path"))
        good = found.filter(F.col(BROKEN).isNull()).withColumn("provenance", source).drop("file", "file_name", "value", BROKEN)
        return good, found.filter(F.col(BROKEN).isNotNull()).select("file", F.col("value").alias("record"))
    rows = spark.read.schema(marked).option("columnNameOfCorruptRecord", BROKEN).json(path, multiLine=True)
    good = rows.filter(F.col(BROKEN).isNull()).withColumn("provenance", _provenance(when)).drop(BROKEN)
    # Spark answers no query on the broken records of files alone; they are few, and written once.
    bad = reliable_checkpoint(rows.filter(F.col(BROKEN).isNotNull()).withColumn("file", file))
    return good, bad.select("file", F.col(BROKEN).alias("record"))


def read_combined(spark: SparkSession, folder: str, schema: str, loaded_at: Column | None = None) -> DataFrame:
    """All ``combined*.json`` of the folder itself, with flight type and date from the name."""
    rows = (
        spark.read.schema(schema).option("pathGlobFilter", "combined*.json").option("recursiveFileLookup", False)
        .json(folder, multiLine=True)
    )
    name = F.col("_metadata.file_name")

    def part(i: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(name, COMBINED_NAME, i), F.lit("")), F.lit("unknown"))

    return rows.withColumn(
        "provenance",
        _provenance(
            F.current_timestamp() if loaded_at is None else loaded_at, flight_type=part(1), flight_date=part(2),
            collection_type=F.lit("flights"),
        ),
    )


def documents_per_file(docs: DataFrame) -> DataFrame:
    return docs.groupBy(
        F.col("provenance.source_file").alias("source_file"),
        F.col("provenance.flight_type").alias("flight_type"),
        F.col("provenance.flight_date").alias("flight_date"),
    ).agg(F.count(F.lit(1)).alias("documents"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_flight_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A training or scoring export; every column is text, typed by the feature step."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, nullValue="")


def write_predictions_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
