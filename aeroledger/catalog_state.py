"""Registered queries over states, copies, checks and functions: timers, digest trees, checked writes, SQL functions."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from . import fixtures as fx
from .catalog import _pages, _wx, query
from .catalog_io import _files_of, _moment
from .functions import sql
from .operators import merge, quality, snapshots
from .session import run_dir
from .sources import documents, feeds
from .streaming import jobs, states

LOADED = "2024-02-01 00:00:00"


# ---- streams ------------------------------------------------------------------------

@query
def stream_station_state(spark, folder):
    """Newest report per station over files that land in order, with stations that fell silent for a day."""
    cuts = ["2024-01-06", "2024-01-13", "2024-01-20"]
    parts = [f"ts < '{cuts[0]}'", *[f"ts >= '{a}' and ts < '{b}'" for a, b in zip(cuts, cuts[1:])], f"ts >= '{cuts[-1]}'"]
    source, schema, files = _files_of(spark, folder, "events", parts, "reports")
    reports = jobs.read_new(spark, source, "parquet", schema, files_per_batch=files).selectExpr(
        "concat('U', user_id % 997) as station_id", "event_id as metar_id", "ts as observation_time"
    )
    base = run_dir(spark, "stations")
    with states.timers(spark):
        jobs.append_available(states.newest_with_timers(reports), f"{base}/changes", f"{base}/progress")
    return states.current(spark.read.schema(states.CHANGES).parquet(f"{base}/changes"))


# Hours of landed files in one batch: the state of a join holds the rows of so long, and of those that may still meet.
BATCH_HOURS = 24


def _landed_hourly(spark, rows, moment, path):
    """A stream of ``rows`` as they land: a file an hour of ``moment``, in the order of the hours; those without a time first.

    A batch takes whole hours, so none of its rows is late for the watermark of the batch before.
    """
    hour = F.coalesce(F.floor(F.unix_micros(F.col(moment).cast("timestamp")) / 3_600_000_000), F.lit(-(1 << 40))).alias("hour")
    rows.select("*", hour).repartition("hour").write.partitionBy("hour").parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    hours = {int(s.getPath().getName()[5:]): s.getPath() for s in store.listStatus(place) if s.isDirectory()}
    landed = int(time.time()) - len(hours)
    for after, number in enumerate(sorted(hours)):
        for status in store.listStatus(hours[number]):
            # A stream reads files by their age.
            store.setTimes(status.getPath(), (landed + after) * 1000, -1)
    return jobs.read_new(spark, path, "parquet", rows.schema, files_per_batch=BATCH_HOURS).select(*rows.columns)


@query
def stream_joined_actuals(spark, folder):
    """Flights and late records as two streams, joined where a record comes within two days of departure."""
    base = run_dir(spark, "two_streams")
    start = "timestamp_ntz'2024-01-01 00:00:00' + interval '1' hour * cast({} % 480 as int)"
    flights = fx.table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as string) as flight_number", "'AAA' as from_airport", "'BBB' as to_airport",
        f"{start.format('o_orderkey')} as departure_scheduled_utc",
    )
    late = fx.table(spark, folder, "lineitem").selectExpr(
        "cast(l_orderkey as string) as flight_number", "'AAA' as from_airport", "'BBB' as to_airport",
        f"{start.format('l_orderkey')} as departure_scheduled_utc",
        f"{start.format('l_orderkey')} + interval '1' hour * cast(l_partkey % 60 as int) as collected_at",
        "cast(null as timestamp_ntz) as departure_final_utc", "cast(null as timestamp_ntz) as arrival_actual_utc",
        "concat(l_returnflag, l_linenumber, '-', l_partkey, '-', l_suppkey) as status_final", "cast(l_quantity as int) as delay_min",
    )
    sides = [
        _landed_hourly(spark, rows, moment, f"{base}/{name}")
        for name, rows, moment in (("flights", flights, "departure_scheduled_utc"), ("late", late, "collected_at"))
    ]
    joined = jobs.flights_with_actuals(*sides)
    kept = joined.selectExpr("flight_number", "late_status_final as status_final", "late_delay_min as delay_min")
    jobs.append_available(kept, f"{base}/joined", f"{base}/progress")
    # Flights whose time has not passed yet are still awaited; those with a record are out at once.
    return spark.read.parquet(f"{base}/joined").where("status_final is not null")


# ---- copies -------------------------------------------------------------------------

@query
def snapshot_tree_delta(spark, folder):
    """The difference of two stored copies, from the buckets whose digests differ."""
    rows = fx.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    new = rows.withColumn("l_returnflag", F.expr("if(l_quantity > 45, 'X', l_returnflag)"))
    places = []
    for name, copy in (("old", rows), ("new", new)):
        places.append(run_dir(spark, f"copy_{name}"))
        snapshots.store(copy, places[-1], 256, 16)
    return snapshots.delta(spark, *places, rows.schema, 16)


@query
def upsert_bucketed(spark, folder):
    """The counted upsert into a table that is bucketed by its key: the table is not shuffled."""
    target = fx.table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey * 2 as string) as doc_id", "o_orderstatus as status", "'s1' as collection_session_id",
        "o_orderkey % 3 > 0 as is_updated", "o_orderkey % 3 as update_count", "cast(null as timestamp_ntz) as last_updated_at",
        "cast(null as string) as previous_collection_session_id", "case when o_orderkey % 4 = 0 then concat('M', o_orderkey) end as metar_id",
    )
    source = fx.table(spark, folder, "lineitem").selectExpr(
        "cast(l_orderkey as string) as doc_id", "l_returnflag as status", "'s2' as collection_session_id",
        "cast(null as string) as metar_id", "l_linenumber", "l_partkey", "l_suppkey",
    )
    path = run_dir(spark, "bucketed")
    stored = merge.store_bucketed(target, f"documents_{path[-32:]}", "doc_id", 16, path)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "status"]
    return merge.replace_upsert(stored, source, "doc_id", order, F.expr(f"timestamp_ntz'{LOADED}'"), keep=("metar_id",))


# ---- checks -------------------------------------------------------------------------

@query
def written_checks(spark, folder):
    """Violations that were counted while four tables were written."""
    checks = [
        *quality.weather_checks(),
        quality.Check("flight.delay_risk_level not_null", "flight", "not_null", ("delay_risk_level",)),
        quality.Check("flight.status accepted", "flight", "accepted", ("status",), values=("LANDED", "SCHEDULED")),
        quality.Check("metar.flight_category not_null", "metar", "not_null", ("flight_category",)),
        quality.Check("taf.change_indicator accepted", "taf", "accepted", ("change_indicator",), values=("FM", "BECMG")),
    ]
    sky = fx.sky_condition(spark, folder).withColumn("taf_fk", F.expr("if(id % 3 = 0, id, taf_fk)"))
    tables = {"flight": fx.flights(spark, folder), "metar": fx.metar(spark, folder), "taf": fx.taf(spark, folder), "sky": sky}
    return quality.write_checked(tables, run_dir(spark, "checked"), checks)


def _feed_with_breaks(spark, folder):
    """One element per line, some of which lack an end tag or hold an unknown entity."""
    base = run_dir(spark, "broken")
    stamp = "date_format(observation_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    fx.metar(spark, folder).selectExpr(
        f"concat('<METAR><raw_text>R', id, if(id % 23 = 5, '&nope;', ''), '</raw_text><station_id>', station_id, '</station_id><observation_time>',"
        f" {stamp}, if(id % 17 = 3, '', '</observation_time>'), '</METAR>') as value"
    ).write.text(base)
    return feeds.read_checked(spark, base, "METAR", _moment(LOADED))


@query
def metar_checked(spark, folder):
    return _feed_with_breaks(spark, folder)[0].select("raw_text", "station_id")


@query
def metar_quarantine(spark, folder):
    """Elements that could not be read, with their text as it stands in the file."""
    bad = _feed_with_breaks(spark, folder)[1]
    return bad.select(F.regexp_extract("record", "<raw_text>R([0-9]+)", 1).cast("long").alias("id"), F.col("file").isNotNull().alias("has_file"))


@query
def json_quarantine(spark, folder):
    """Lines of a JSON file that hold no whole document, and the documents of all others."""
    base = run_dir(spark, "lines")
    fx.table(spark, folder, "events").selectExpr(
        "concat('{\"event_id\": ', event_id, ', \"event_type\": \"', event_type, if(event_id % 19 = 4, '', '\"}')) as value"
    ).write.text(base)
    good, bad = documents.read_json_checked(spark, base, "event_id long, event_type string", lines=True)
    said = F.regexp_extract("record", "([0-9]+)", 1).cast("long")
    return good.select("event_id", F.lit(False).alias("broken")).unionByName(bad.select(said.alias("event_id"), F.lit(True).alias("broken")))


# ---- SQL functions ------------------------------------------------------------------

@query
def sql_similarity(spark, folder):
    """Trigram similarity by SQL text."""
    sql.register(spark)
    parts = fx.table(spark, folder, "part")
    return spark.sql(
        "select p_partkey, round(trigram_similarity(p_name, concat(p_type, ' ', substr(p_name, 1, 5))), 9) as score from {parts}", parts=parts
    )


@query
def sql_weather(spark, folder):
    """Weather strings in words and their class, by SQL text."""
    sql.register(spark)
    return spark.sql("select id, wx, decode_weather(wx) as words, weather_severity(wx) as severity from {rows}", rows=_wx(spark, folder))


@query
def sql_boards(spark, folder):
    """Rows of board pages by SQL text, a table function beside each page."""
    sql.register(spark)
    return spark.sql(
        "select p.k, b.place, b.departure, b.status from {pages} p, lateral board_rows(p.path, p.html) b where b.error is null",
        pages=_pages(spark, folder),
    )
