"""Scheduled micro-batches as Structured Streaming jobs.

Every job reads what is new, stops, and can be run again: progress is in the
checkpoint folder. Appending sinks are exactly-once by themselves; merging ones
write version ``n + 1`` from version ``n`` in batch ``n``, so a replayed batch
writes the same version again.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import associate, merge
from ..session import reliable_checkpoint, stored
from ..sources.feeds import METAR_SCHEMA, TAF_SCHEMA, metar_documents, taf_documents

SETTLING = "24 hours"


# ---- sources -----------------------------------------------------------------

def read_new(
    spark: SparkSession, folder: str, form: str, schema, pattern: str | None = None,
    files_per_batch: int | None = None, **options,
) -> DataFrame:
    """New files of a folder, also late ones; ``files_per_batch`` cuts a backlog into batches."""
    reader = spark.readStream.format(form).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Without this, Spark leaves out files much older than the newest one it has seen.
    reader = reader.option("maxFileAge", "36500d")
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(folder)


def new_metar(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reports = read_new(spark, folder, "xml", METAR_SCHEMA, files_per_batch=files_per_batch, rowTag="METAR")
    return metar_documents(reports, F.col("_metadata.file_path"), F.current_timestamp())


def new_taf(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reports = read_new(spark, folder, "xml", TAF_SCHEMA, files_per_batch=files_per_batch, rowTag="TAF")
    return taf_documents(reports, F.col("_metadata.file_path"), F.current_timestamp())


# ---- sinks -------------------------------------------------------------------

def append_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append all that is available to a Parquet table, then stop."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/version={number}"


def latest_version(spark: SparkSession, root: str) -> int:
    """Highest complete version below ``root``; -1 if there is none."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return -1
    numbers = [-1]
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            numbers.append(int(name.split("=")[1]))
    return max(numbers)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(version_path(root, latest_version(spark, root)))


def merge_available(
    stream: DataFrame, root: str, checkpoint: str, step: Callable[[DataFrame, DataFrame], DataFrame],
    mode: str = "append",
) -> None:
    """Apply ``step(table, batch)`` per batch to a versioned table; version 0 must exist."""
    spark = stream.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        current = spark.read.parquet(version_path(root, number))
        step(current, batch).write.mode("overwrite").parquet(version_path(root, number + 1))

    query = (
        stream.writeStream.foreachBatch(apply).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


# ---- tables whose partitions are replaced one by one -----------------------------

def _manifest_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/manifest/version={number}"


# Columns that name a row's partition and its folder while a version is written.
PART, PLACE = "_part_name", "_part_place"


def _part(part: Column) -> Column:
    """A partition's name; rows without one share a partition of their own."""
    return F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit("-"))


def start_partitions(table: DataFrame, root: str, part: Column) -> None:
    """Version 0 of a partitioned table; ``part`` names a row's partition, such as its day."""
    _write_partitions(table, root, 0, part, {})


def _write_partitions(rows: DataFrame, root: str, number: int, part: Column, kept: dict[str, str]) -> None:
    """Write ``rows`` as the partitions of version ``number``; ``kept`` stay where they are.

    A partition's folder is named by a digest, so its own name may hold any character.
    """
    spark = rows.sparkSession
    target = f"{root.rstrip('/')}/data/version={number}"
    named = reliable_checkpoint(rows.withColumn(PART, _part(part)))
    folders = named.withColumn(PLACE, F.md5(F.col(PART).cast("binary"))).drop(PART)
    folders.hint("rebalance", F.col(PLACE)).write.mode("overwrite").partitionBy(PLACE).parquet(target)
    # One row per partition that the batch touched.
    written = [r[PART] for r in named.select(PART).distinct().collect()]
    places = kept | {name: f"{target}/{PLACE}={hashlib.md5(name.encode()).hexdigest()}" for name in written}
    # The row without path keeps the schema of a table that has no partition.
    listed = [(name, path, rows.schema.json()) for name, path in [("", None), *sorted(places.items())]]
    manifest = spark.createDataFrame(listed, "part string, path string, schema string")
    manifest.coalesce(1).write.mode("overwrite").parquet(_manifest_path(root, number))


def _manifest(spark: SparkSession, root: str, number: int) -> tuple[dict[str, str], StructType]:
    """Place of each partition and the table's schema."""
    listed = spark.read.parquet(_manifest_path(root, number)).collect()
    return {r["part"]: r["path"] for r in listed if r["path"]}, StructType.fromJson(json.loads(listed[0]["schema"]))


def read_partitions(spark: SparkSession, root: str, number: int | None = None, parts: list[str | None] | None = None) -> DataFrame:
    """A version of a partitioned table, or only some of its partitions (None: the one of rows without a partition)."""
    if number is None:
        number = latest_version(spark, f"{root.rstrip('/')}/manifest")
    return _read_named(spark, root, number, None if parts is None else ["-" if p is None else f"={p}" for p in parts])


def _read_named(spark: SparkSession, root: str, number: int, names: list[str] | None) -> DataFrame:
    places, schema = _manifest(spark, root, number)
    paths = [path for name, path in places.items() if names is None or name in names]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_partitions_available(
    stream: DataFrame, root: str, checkpoint: str, step: Callable[[DataFrame, DataFrame], DataFrame], part: str,
    mode: str = "append", moved_by: list[str] | None = None, keep_versions: int | None = None,
) -> None:
    """Apply ``step(table, batch)`` to the partitions that a batch touches; the others keep their files.

    ``part`` is an SQL expression over table rows and batch rows alike. Batch ``n`` reads
    manifest ``n`` and writes manifest ``n + 1``, so a replayed batch writes the same again.
    Where the partition does not follow from a row's key, ``moved_by`` names the key: the partitions that
    hold the batch's keys now are then merged too (their key columns are read in all partitions), so a row
    that moves leaves its old place. With ``keep_versions`` older versions are dropped after each batch.
    """
    spark = stream.sparkSession
    name = _part(F.expr(part))

    def apply(batch: DataFrame, number: int) -> None:
        kept_batch = reliable_checkpoint(batch)
        rows = kept_batch.select(name.alias(PART))
        if moved_by:
            stored = read_partitions(spark, root, number)
            known = stored.join(kept_batch.select(*moved_by).distinct(), moved_by, "left_semi")
            rows = rows.unionByName(known.select(name.alias(PART)))
        # One row per touched partition.
        touched = [r[PART] for r in rows.distinct().collect()]
        places, _ = _manifest(spark, root, number)
        current = _read_named(spark, root, number, touched)
        kept = {p: path for p, path in places.items() if p not in touched}
        _write_partitions(step(current, kept_batch), root, number + 1, F.expr(part), kept)
        if keep_versions:
            drop_versions(spark, root, keep_versions)

    query = (
        stream.writeStream.foreachBatch(apply).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` versions of a partitioned table, and the folders that only they name.

    A batch that is replayed reads the version before the newest, so at least two stay. Returns the dropped versions.
    """
    root = root.rstrip("/")
    last = latest_version(spark, f"{root}/manifest")
    first_kept = max(0, last - max(keep, 2) + 1)
    used = {path for n in range(first_kept, last + 1) for path in _manifest(spark, root, n)[0].values()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    dropped = []
    for number in range(first_kept):
        manifest, data = path(_manifest_path(root, number)), path(f"{root}/data/version={number}")
        if store.exists(manifest):
            store.delete(manifest, True)
            dropped.append(number)
        if store.exists(data):
            for status in store.listStatus(data):
                if status.isDirectory() and f"{root}/data/version={number}/{status.getPath().getName()}" not in used:
                    store.delete(status.getPath(), True)
    return dropped


# ---- transformations ---------------------------------------------------------

def first_copies(stream: DataFrame, keys: list[str], time: str, delay: str = SETTLING) -> DataFrame:
    """One copy per key; state is dropped once copies can no longer arrive."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def settled_windows(stream: DataFrame, time: str, width: str, delay: str = SETTLING, *aggregates) -> DataFrame:
    """Tumbling windows, emitted once they are ``delay`` older than the newest event."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.groupBy(F.window(time, width).alias("w")).agg(*aggregates).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "*"
    ).drop("w")


def latest_reports(stream: DataFrame) -> DataFrame:
    """Newest report per station; the state is one row per station."""
    return stream.groupBy("station_id").agg(
        F.max(F.struct("observation_time", "id")).alias("newest")
    ).select(
        "station_id", F.col("newest.id").alias("metar_id"), F.col("newest.observation_time").alias("observation_time")
    )


def keep_latest(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge step: per station the newer of the stored and the new report."""
    both = table.unionByName(batch)
    return both.groupBy("station_id").agg(
        F.max(F.struct("observation_time", "metar_id")).alias("newest")
    ).select("station_id", "newest.metar_id", "newest.observation_time")


def flights_with_actuals(
    flights: DataFrame, actuals: DataFrame, flight_delay: str = "1 hour", actual_delay: str = "1 hour",
    within: str = "48 hours",
) -> DataFrame:
    """Flights left-joined to late records that arrive within ``within`` of departure.

    Two streams: the bound lets Spark drop old state, and a flight without a
    record is emitted with nulls when its time has passed. Departures meet as numbers: a key that carried the
    watermark itself would end a flight at its departure, before the records of a later batch.
    """
    key = merge.FLIGHT_KEY
    planned = flights.withColumn(key[3], F.col(key[3]).cast("timestamp")).withWatermark(key[3], flight_delay)
    late = actuals.select(
        *[F.col(c).alias(f"late_{c}") for c in key], "collected_at",
        *[F.col(c).alias(f"late_{c}") for c in merge.ACTUALS],
    ).withColumn("collected_at", F.col("collected_at").cast("timestamp")).withColumn(
        f"late_{key[3]}", F.col(f"late_{key[3]}").cast("timestamp")
    ).withWatermark("collected_at", actual_delay)
    same = [F.col(c) == F.col(f"late_{c}") for c in key[:3]]
    same.append(F.unix_micros(key[3]) == F.unix_micros(f"late_{key[3]}"))
    bound = (F.col("collected_at") >= F.col(key[3])) & (
        F.col("collected_at") <= F.col(key[3]) + F.expr(f"interval {within}")
    )
    return planned.join(late, [*same, bound], "left_outer")


def insert_step(keys: list[str], order: list[str]):
    """Merge step: insert rows whose key is new."""
    return lambda table, batch: merge.insert_ignore(table, batch, keys, order)


def upsert_step(key: str, order: list[str], now):
    """Merge step: replace documents and count their updates."""
    return lambda table, batch: merge.replace_upsert(table, batch, key, order, now)


def actuals_step(order: list[str]):
    """Merge step: late records correct stored flights."""
    return lambda table, batch: merge.late_actuals(table, batch, order).select(*table.columns)


def link_step(taf: DataFrame, airports: DataFrame, keys: list[str], order: list[str]):
    """Merge step: flights of the batch get their best forecast (static table).

    A flight that comes again replaces its stored row, so repeated pulls leave one
    row per key; ``order`` picks among copies within a batch. The distinct forecasts are made by the first batch
    and read by all others.
    """
    @functools.cache
    def forecasts() -> DataFrame:
        return associate.distinct_forecasts(taf)

    def step(table: DataFrame, batch: DataFrame) -> DataFrame:
        # Read for the pairs that are asked, and again by the flights that take the answers.
        newest = stored(merge.last_per_key(associate.without_codeshares(batch), keys, order), "newest")
        linked = associate.link_best_taf(newest, taf, airports, forecasts=forecasts())
        return merge.upsert(table, linked.select(*table.columns), keys)

    return step
