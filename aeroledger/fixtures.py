"""Flight, weather and reference tables derived from the generic test tables.

Every table is a lazy projection or join over the given Parquet files, so its
size follows them. ``oracles/prelude.py`` states the same tables as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "timestamp_ntz'2024-01-01 00:00:00'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, seen as a flight."""
    # Orders meet customers and lines meet suppliers first, so every line is shuffled once, by its order.
    of_order = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus").join(
        table(spark, folder, "customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey")
    )
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), F.expr("l_suppkey = s_suppkey")
    )
    joined = lines.join(of_order, F.expr("l_orderkey = o_orderkey"))
    minute = "cast((l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 43200 as int)"
    shaped = joined.selectExpr(
        "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as row_key",
        "concat('A', substr(o_orderpriority, 1, 1), l_partkey % 500) as flight_number",
        "concat('A', substr(o_orderpriority, 1, 1)) as airline_code",
        "concat('AP', lpad(s_nationkey, 2, '0')) as from_airport",
        "concat('AP', lpad(c_nationkey, 2, '0')) as to_airport",
        "cast(null as string) as aircraft_code",
        "l_orderkey as departure_metar_fk",
        "l_partkey as arrival_taf_fk",
        f"{BASE} + interval '1' minute * {minute} as departure_scheduled_utc",
        f"{BASE} + interval '1' minute * ({minute} + 60 + cast(l_partkey % 600 as int)) as arrival_scheduled_utc",
        "case when l_returnflag = 'N' then null else cast(l_quantity as int) - 10 end as delay_min",
        "case when l_returnflag = 'N' then null else cast(l_quantity as int) - 15 end as departure_shift",
        "round(l_discount * 10, 4) as delay_prob",
        "case when l_linenumber = 7 then null when l_discount < 0.03 then 'low'"
        " when l_discount < 0.07 then 'medium' else 'high' end as delay_risk_level",
        "case o_orderstatus when 'P' then 'SCHEDULED' when 'O' then 'CANCELLED' else 'LANDED' end as status",
        "case when l_returnflag = 'N' then null else 'LANDED' end as status_final",
        "case when l_suppkey % 5 = 0 then concat('XX', l_suppkey) end as operated_by",
        "concat('T', l_linenumber) as departure_terminal",
        "concat('G', l_suppkey) as departure_gate",
        "cast(null as string) as arrival_terminal",
        "cast(null as string) as arrival_gate",
    )
    return shaped.selectExpr(
        "* except (departure_shift)",
        "departure_scheduled_utc + interval '1' minute * departure_shift as departure_actual_utc",
        "arrival_scheduled_utc + interval '1' minute * delay_min as arrival_actual_utc",
    )


def metar(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event, seen as a weather report."""
    scaled = table(spark, folder, "events").selectExpr(
        "*", "cast(round(value * 100) as bigint) as v"
    )
    shaped = scaled.selectExpr(
        "event_id as id",
        "concat('M', event_id) as external_id",
        "concat('ZZ', lpad(user_id % 25, 2, '0')) as station_id",
        "ts as observation_time",
        "cast((event_id * 10) % 360 as string) as wind_dir_degrees",
        "cast(cast((v % 4000) - 500 as double) / 100 as decimal(5,2)) as temp_c",
        "cast(cast((v % 4000) - 800 as double) / 100 as decimal(5,2)) as dewpoint_c",
        "cast(v % 35 as int) as wind_speed_kt",
        "case when event_id % 3 = 0 then cast(v % 35 + 10 as int) end as wind_gust_kt",
        "case when event_id % 17 <> 0 then cast(cast(v % 1200 as double) / 100 as decimal(5,2)) end"
        " as visibility_statute_mi",
        "cast(cast(2900 + v % 150 as double) / 100 as decimal(5,2)) as altim_in_hg",
        "case event_type when 'click' then '-RA' when 'view' then 'FG' when 'purchase' then 'TSRA'"
        " when 'error' then '+SN' end as wx_string",
        "case when event_id % 2 = 0 then 'METAR' else 'SPECI' end as metar_type",
    )
    return shaped.selectExpr(
        "*",
        "case when visibility_statute_mi is null then null when visibility_statute_mi < 1 then 'LIFR'"
        " when visibility_statute_mi < 3 then 'IFR' when visibility_statute_mi < 5 then 'MVFR'"
        " else 'VFR' end as flight_category",
    )


def taf(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event, seen as one forecast period."""
    return table(spark, folder, "events").selectExpr(
        "event_id as id",
        "concat('T', event_id) as external_id",
        "concat('ZZ', lpad(user_id % 25, 2, '0')) as station_id",
        "ts as issue_time",
        "date_trunc('hour', ts) as fcst_time_from",
        "case when event_id % 10 = 0 then null else date_trunc('hour', ts)"
        " + interval '1' hour * cast(1 + event_id % 12 as int) end as fcst_time_to",
        "case event_type when 'click' then 'FM' when 'view' then 'BECMG' when 'purchase' then 'TEMPO'"
        " when 'signup' then 'PROB' end as change_indicator",
        "cast((event_id * 20) % 360 as int) as wind_dir_degrees",
        "cast(event_id % 40 as int) as wind_speed_kt",
        "case when event_id % 4 = 0 then cast(event_id % 40 + 5 as int) end as wind_gust_kt",
        "cast(cast(event_id % 700 as double) / 100 as decimal(5,2)) as visibility_statute_mi",
        "case event_type when 'click' then 'BR' when 'view' then 'SHRA' when 'purchase' then 'FZRA' end"
        " as wx_string",
    ).selectExpr(
        "* except (fcst_time_from, fcst_time_to)",
        "cast(fcst_time_from as timestamp_ntz) as fcst_time_from",
        "cast(fcst_time_to as timestamp_ntz) as fcst_time_to",
    )


def sky_condition(spark: SparkSession, folder: str) -> DataFrame:
    """Zero to four layers per report and zero to three per forecast."""
    events = table(spark, folder, "events").select("event_id")
    of_metar = events.filter("event_id % 5 > 0").selectExpr(
        "event_id", "explode(sequence(1, cast(event_id % 5 as int))) as k"
    ).selectExpr(
        "event_id * 8 + k as id", "event_id as metar_fk", "cast(null as bigint) as taf_fk", "k"
    )
    of_taf = events.filter("event_id % 4 > 0").selectExpr(
        "event_id", "explode(sequence(1, cast(event_id % 4 as int))) as k"
    ).selectExpr(
        "event_id * 8 + 4 + k as id", "cast(null as bigint) as metar_fk", "event_id as taf_fk", "k"
    )
    return of_metar.unionByName(of_taf).selectExpr(
        "id", "metar_fk", "taf_fk",
        "element_at(array('FEW', 'SCT', 'BKN', 'OVC'), k) as sky_cover",
        "cast(1000 * k as int) as cloud_base_ft_agl",
        "case when k = 4 then 'CB' end as cloud_type",
        "k as condition_order",
    )


def airports(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "n_nationkey as id",
        "concat('AP', lpad(n_nationkey, 2, '0')) as iata_code",
        "concat('ZZ', lpad(n_nationkey, 2, '0')) as icao_code",
        "element_at(array('Europe/Paris', 'America/New_York', 'Asia/Tokyo', 'UTC', 'Australia/Sydney'),"
        " n_regionkey + 1) as timezone",
        "concat(n_name, ' International Airport') as airport_name",
        "n_name as city",
    )


def airlines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .select("o_orderpriority")
        .distinct()
        .selectExpr(
            "concat('A', substr(o_orderpriority, 1, 1)) as iata",
            "substr(o_orderpriority, 3) as name",
            "case when cast(substr(o_orderpriority, 1, 1) as int) % 2 = 1 then 'Y' else 'N' end as active",
        )
    )
