"""Merges as pure functions: ``(target, source) -> new table``.

Parquet tables have no MERGE, so a merge returns the full new content and the
caller writes it to a new version folder (or only the partitions that a batch
touches, see ``streaming.jobs``). Sources are reduced to one row per key with an
aggregate, which combines before the shuffle, so a key that repeats a million
times in a batch costs one row per task. The reduced source is written once and,
if it is small, sent to the target's rows, so the target is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import sized_broadcast, written


def _one_per_key(df: DataFrame, keys: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("kept"))
    return kept.select(*keys, "kept.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; ``order`` must end in a unique column."""
    return _one_per_key(df, keys, lambda row: F.min_by(row, F.struct(*order)))


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, lambda row: F.max_by(row, F.struct(*order)))


def surrogate_id(df: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """A 64-bit id from the business key: equal on every run, unlike a sequence.

    Two keys may share an id (to be expected near 10^10 rows): see ``shared_ids``.
    """
    return df.withColumn(name, F.xxhash64(*keys))


def shared_ids(df: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """Ids that stand for more than one business key, with the number of keys."""
    return df.groupBy(name).agg(F.count_distinct(F.struct(*keys)).alias("keys")).filter("keys > 1")


# ---- inserts -----------------------------------------------------------------

def new_rows(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Source rows whose key is not in the target, first one per key."""
    fresh, lookup = written(first_per_key(source, keys, order), keys)
    known = target.select(*keys).join(lookup, keys, "left_semi").distinct()
    return fresh.join(known, keys, "left_anti")


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target plus new rows; rows already present stay as they are."""
    return target.unionByName(new_rows(target, source, keys, order))


def insert_counts(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str], batch: str
) -> DataFrame:
    """Per batch: rows offered, rows inserted, duplicates ignored."""
    offered = source.groupBy(batch).agg(F.count(F.lit(1)).alias("offered"))
    inserted = new_rows(target, source, keys, order).groupBy(batch).agg(F.count(F.lit(1)).alias("inserted"))
    return offered.join(inserted, batch, "left").select(
        batch, "offered", F.coalesce("inserted", F.lit(0)).alias("inserted"),
        (F.col("offered") - F.coalesce("inserted", F.lit(0))).alias("duplicates"),
    )


def insert_with_children(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str],
    children: DataFrame, child_link: str, parent_key: str,
) -> tuple[DataFrame, DataFrame]:
    """New parents, and the child rows of those parents only."""
    added = new_rows(target, source, keys, order)
    return added, children.join(
        added.select(F.col(parent_key).alias(child_link)), child_link, "left_semi"
    )


# ---- upserts -----------------------------------------------------------------

def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """All columns overwritten on a key conflict, other rows kept.

    Without ``order`` the source must hold one row per key.
    """
    fresh, lookup = written(last_per_key(source, keys, order) if order else source, keys)
    return target.join(lookup, keys, "left_anti").unionByName(fresh)


def store_bucketed(table: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write a table in ``buckets`` buckets of its key, sorted within them; as it reads back.

    Tables that are bucketed alike meet in ``upsert`` and ``replace_upsert`` without a shuffle of either; a source
    that is not bucketed is shuffled into the target's buckets, the target stays where it is.
    """
    table.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return table.sparkSession.table(name)


def replace_upsert(
    target: DataFrame, source: DataFrame, key: str, order: list[str], now: Column,
    keep: tuple[str, ...] = ("metar_id", "taf_id"),
) -> DataFrame:
    """Replace documents by id and maintain their update counters.

    A document seen k times in one batch counts as k writes. Columns in ``keep``
    are links made after collection: a later copy without them must not lose them.
    """
    marks = ["is_updated", "update_count", "last_updated_at", "previous_collection_session_id"]
    fresh_cols = [c for c in source.columns if c != key]
    fresh = source.groupBy(key).agg(
        F.max_by(F.struct(*fresh_cols), F.struct(*order)).alias("fresh"),
        F.count(F.lit(1)).alias("writes"),
    )
    stored = target.select(key, F.struct(*[c for c in target.columns if c != key]).alias("stored"))
    joined = stored.join(fresh, key, "full_outer")
    seen, known = F.col("fresh").isNotNull(), F.col("stored").isNotNull()
    again = known | (F.col("writes") > 1)

    values = {
        "is_updated": F.when(~seen, F.col("stored.is_updated")).otherwise(again),
        "update_count": F.when(~seen, F.col("stored.update_count")).when(
            known, F.coalesce("stored.update_count", F.lit(0)) + F.col("writes")
        ).otherwise(F.col("writes") - 1),
        "last_updated_at": F.when(~seen, F.col("stored.last_updated_at")).when(again, now),
        "previous_collection_session_id": F.when(
            ~seen, F.col("stored.previous_collection_session_id")
        ).when(F.col("writes") > 1, F.col("fresh.collection_session_id")).when(
            known, F.col("stored.collection_session_id")
        ),
    }
    columns = []
    for name in target.columns:
        if name == key:
            value = F.col(key)
        elif name in marks:
            value = values[name]
        elif name not in fresh_cols:
            value = F.when(~seen | F.lit(name in keep), F.col(f"stored.{name}"))
        elif name in keep:
            value = F.coalesce(f"fresh.{name}", f"stored.{name}")
        else:
            value = F.when(seen, F.col(f"fresh.{name}")).otherwise(F.col(f"stored.{name}"))
        columns.append(value.cast(target.schema[name].dataType).alias(name))
    return joined.select(*columns)


# ---- keyed updates -----------------------------------------------------------

FLIGHT_KEY = ["flight_number", "from_airport", "to_airport", "departure_scheduled_utc"]
ACTUALS = ["departure_final_utc", "arrival_actual_utc", "status_final", "delay_min"]


def insert_flights(target: DataFrame, source: DataFrame, order: list[str]) -> DataFrame:
    """New flights by business key, so that a replay adds nothing."""
    return insert_ignore(target, source, FLIGHT_KEY, order)


def late_actuals(flights: DataFrame, actuals: DataFrame, order: list[str]) -> DataFrame:
    """Overwrite final times, status and delay of flights named by late records.

    The last record per key wins. Records without number or airports are
    skipped, and a null scheduled time matches nothing.
    """
    usable = actuals.filter(
        "coalesce(flight_number, '') <> '' and coalesce(from_airport, '') <> '' "
        "and coalesce(to_airport, '') <> '' and departure_scheduled_utc is not null"
    )
    latest = sized_broadcast(usable.groupBy(*FLIGHT_KEY).agg(
        F.max_by(F.struct(*ACTUALS), F.struct(*order)).alias("late")
    ))
    out = [
        F.when(F.col("late").isNotNull(), F.col(f"late.{c}")).otherwise(
            F.col(c) if c in flights.columns else F.lit(None)
        ).alias(c)
        for c in ACTUALS
    ]
    kept = [c for c in flights.columns if c not in ACTUALS]
    return flights.join(latest, FLIGHT_KEY, "left").select(*kept, *out)


def write_back_predictions(flights: DataFrame, predictions: DataFrame, key: str = "id") -> DataFrame:
    """Store probability and risk level by flight id; a null or NaN probability is skipped."""
    scored = predictions.filter(
        F.col("delay_probability").isNotNull() & ~F.isnan(F.col("delay_probability").cast("double"))
    )
    latest = sized_broadcast(scored.groupBy(key).agg(
        F.max(F.struct("delay_probability", "risk_level")).alias("scored")
    ))
    kept = [c for c in flights.columns if c not in ("delay_prob", "delay_risk_level")]
    hit = F.col("scored").isNotNull()
    return flights.join(latest, key, "left").select(
        *kept,
        F.when(hit, F.col("scored.delay_probability")).otherwise(F.col("delay_prob")).alias("delay_prob"),
        F.when(hit, F.col("scored.risk_level")).otherwise(F.col("delay_risk_level")).alias("delay_risk_level"),
    )


def set_links(flights: DataFrame, links: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Set association columns from a result table; flights without a result keep theirs."""
    found = sized_broadcast(links.select(key, F.struct(*columns).alias("found")))
    kept = [c for c in flights.columns if c not in columns]
    return flights.join(found, key, "left").select(
        *kept,
        *[
            F.coalesce(f"found.{c}", c).alias(c) if c in flights.columns else F.col(f"found.{c}").alias(c)
            for c in columns
        ],
    )


def cascade_delete(children: DataFrame, link: str, parents: DataFrame, key: str = "id") -> DataFrame:
    """Children that still have their parent, or that never had one of this kind."""
    alive = children.join(parents.select(F.col(key).alias(link)), link, "left_semi")
    return alive.unionByName(children.filter(F.col(link).isNull())).select(*children.columns)


def write_version(df: DataFrame, root: str, version: str, partition_by: list[str] | None = None) -> str:
    """Write a table version to its own folder; readers switch once it is complete."""
    path = f"{root.rstrip('/')}/version={version}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
