"""Every registered query over the derived tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import clean, text, weather, zones
from .operators import associate, dims, merge, normalize, quality
from .plans import evaluation, features, model, reports, views
from .session import reliable_checkpoint, run_dir, stored
from .sources import boards, feeds, landing, reference
from .streaming import jobs

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def with_doubles(df):
    """Decimals as doubles, for comparison with engines that mean in doubles."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
    )


# ---- reports -----------------------------------------------------------------

@query
def flight_stats(spark, folder):
    return reports.flight_stats(
        fx.flights(spark, folder), date_start="2024-01-03", date_end="2024-01-27"
    )


@query
def daily_stats(spark, folder):
    return reports.daily_stats(fx.flights(spark, folder))


@query
def hourly_stats(spark, folder):
    return reports.hourly_stats(fx.flights(spark, folder))


@query
def airline_stats(spark, folder):
    airlines = fx.airlines(spark, folder)
    return reports.airline_stats(fx.flights(spark, folder), airlines.unionByName(_old_airlines(airlines)), top=3)


@query
def worst_hour(spark, folder):
    flights = fx.flights(spark, folder)
    return reports.worst_hour_and_airline(
        reports.hourly_stats(flights), reports.airline_stats(flights, fx.airlines(spark, folder))
    )


@query
def ml_confusion(spark, folder):
    return reports.confusion(fx.flights(spark, folder))


@query
def risk_distribution(spark, folder):
    return reports.risk_distribution(fx.flights(spark, folder))


@query
def ml_reliability(spark, folder):
    return reports.reliability(fx.flights(spark, folder))


@query
def filter_options(spark, folder):
    return reports.filter_options(fx.flights(spark, folder))


def _search(spark, folder, flights=None, **filters):
    # Every code twice: the copies must neither show nor multiply rows.
    airports, airlines = fx.airports(spark, folder), fx.airlines(spark, folder)
    return with_doubles(reports.search_flights(
        flights if flights is not None else fx.flights(spark, folder), fx.metar(spark, folder),
        airports.unionByName(airports.selectExpr("* except (id, city)", "id + 1000 as id", "'copy' as city")),
        airlines.unionByName(_old_airlines(airlines)), **filters,
    ))


def _old_airlines(airlines):
    """A second, inactive airline for every code."""
    return airlines.selectExpr("iata", "concat('~', name) as name", "'N' as active")


@query
def search_flights(spark, folder):
    return _search(
        spark, folder, flight_number="a1", date_start="2024-01-05", date_end="2024-01-25",
        risk_levels="Low, medium", has_ml_prediction=True,
    )


@query
def search_delayed(spark, folder):
    return _search(
        spark, folder, airline_code="A3", delayed_only=True, predicted_delay_only=True, limit=500
    )


@query
def meteo_stats(spark, folder):
    return reports.meteo_stats(
        fx.metar(spark, folder), fx.taf(spark, folder), fx.sky_condition(spark, folder)
    )


@query
def flight_categories(spark, folder):
    return reports.flight_categories(fx.metar(spark, folder))


@query
def weather_conditions(spark, folder):
    return reports.weather_conditions(
        fx.metar(spark, folder), date_start="2024-01-02", date_end="2024-01-20"
    )


@query
def top_airports(spark, folder):
    return reports.top_airports(fx.metar(spark, folder))


@query
def station_extremes(spark, folder):
    return reports.station_extremes(fx.metar(spark, folder), selected="ZZ07")


@query
def visibility_bins(spark, folder):
    return with_doubles(reports.visibility_bins(fx.metar(spark, folder)))


@query
def wind_bins(spark, folder):
    return reports.wind_bins(fx.metar(spark, folder))


@query
def visibility_timeline(spark, folder):
    return reports.visibility_timeline(fx.metar(spark, folder), station="ZZ03")


@query
def temperature_stats(spark, folder):
    return reports.temperature_stats(fx.metar(spark, folder))


# ---- association -------------------------------------------------------------

def _view(spark, folder):
    return views.wide_view(
        fx.flights(spark, folder), fx.metar(spark, folder), fx.taf(spark, folder),
        fx.sky_condition(spark, folder), key="row_key",
    )


@query
def wide_view(spark, folder):
    return with_doubles(_view(spark, folder).select(
        "f_id", "flight_number", "from_airport", "to_airport", "airline_code", "departure_metar_fk",
        "arrival_taf_fk", "departure_scheduled_utc", "arrival_scheduled_utc", "delay_min", "status",
        "status_final", "m_station_id", "observation_time", "temp_c", "wind_speed_kt", "wind_gust_kt",
        "visibility_statute_mi", "flight_category", "wx_string", "msc_sky_cover",
        "msc_sky_cover_description", "msc_cloud_base_ft_agl", "t_station_id", "fcst_time_from",
        "fcst_time_to", "t_wind_speed_kt", "t_visibility_statute_mi", "t_wx_string", "change_indicator",
        "tsc_sky_cover", "tsc_sky_cover_description",
    ))


@query
def flights_by_ids(spark, folder):
    open_flights = fx.flights(spark, folder).filter("status_final is null").selectExpr("row_key as f_id")
    return views.flights_by_ids(_view(spark, folder), open_flights).select(
        "f_id", "flight_number", "wx_string", "change_indicator", "msc_sky_cover"
    )


@query
def latest_metar(spark, folder):
    return associate.link_latest_metar(
        associate.without_codeshares(fx.flights(spark, folder)), fx.metar(spark, folder),
        fx.airports(spark, folder),
    ).select("row_key", "metar_id", "metar_associated")


def _best_taf(spark, folder, as_of=None):
    return associate.link_best_taf(
        associate.without_codeshares(fx.flights(spark, folder)), fx.taf(spark, folder),
        fx.airports(spark, folder), as_of,
    ).select("row_key", "taf_id", "taf_associated")


@query
def best_taf(spark, folder):
    return _best_taf(spark, folder)


@query
def best_taf_valid(spark, folder):
    return _best_taf(spark, folder, F.expr("timestamp_ntz'2024-01-15 06:00:00'"))


@query
def fk_resolution(spark, folder):
    linked = fx.flights(spark, folder).selectExpr(
        "row_key", "concat('M', departure_metar_fk) as departure_metar_external_id",
        "concat('T', arrival_taf_fk * 2) as arrival_taf_external_id",
        "case when departure_metar_fk % 3 = 0 then departure_metar_fk end as departure_metar_fk",
        "cast(null as bigint) as arrival_taf_fk",
    )
    return associate.resolve_keys(linked, fx.metar(spark, folder), fx.taf(spark, folder)).select(
        "row_key", "departure_metar_fk", "arrival_taf_fk"
    )


@query
def referenced_metar(spark, folder):
    flights = associate.without_codeshares(fx.flights(spark, folder))
    return associate.referenced(fx.metar(spark, folder), flights, "departure_metar_fk").select(
        "id", "station_id"
    )


@query
def sky_parent(spark, folder):
    layers = fx.sky_condition(spark, folder).filter("metar_fk is not null").selectExpr(
        "id", "concat('M', metar_fk * 2) as external_id", "sky_cover", "condition_order"
    )
    return associate.sky_rows_with_parent(layers, fx.metar(spark, folder), "metar_fk")


# ---- merges ------------------------------------------------------------------

def _offers(spark, folder):
    """Reports offered in two batches; the second repeats and changes some."""
    return fx.metar(spark, folder).selectExpr(
        "id", "explode(sequence(1, cast(1 + id % 2 as int))) as batch", "station_id", "wx_string"
    ).selectExpr("id", "batch", "station_id", "concat_ws('/', wx_string, batch) as wx_string")


def _stored(spark, folder):
    return _offers(spark, folder).filter("batch = 1 and id % 3 = 0").selectExpr(
        "id", "0 as batch", "station_id", "'kept' as wx_string"
    )


@query
def insert_ignore(spark, folder):
    return merge.insert_ignore(_stored(spark, folder), _offers(spark, folder), ["id"], ["batch"])


@query
def insert_counts(spark, folder):
    return merge.insert_counts(_stored(spark, folder), _offers(spark, folder), ["id"], ["batch"], "batch")


@query
def insert_with_children(spark, folder):
    _, layers = merge.insert_with_children(
        _stored(spark, folder), _offers(spark, folder), ["id"], ["batch"],
        fx.sky_condition(spark, folder).filter("metar_fk is not null"), "metar_fk", "id",
    )
    return layers.select("id", "metar_fk", "sky_cover", "condition_order")


@query
def upsert_counters(spark, folder):
    target = fx.table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey * 2 as string) as doc_id", "o_orderstatus as status", "'s1' as collection_session_id",
        "o_orderkey % 3 > 0 as is_updated", "o_orderkey % 3 as update_count",
        "cast(null as timestamp_ntz) as last_updated_at",
        "cast(null as string) as previous_collection_session_id",
        "case when o_orderkey % 4 = 0 then concat('M', o_orderkey) end as metar_id",
    )
    source = fx.table(spark, folder, "lineitem").selectExpr(
        "cast(l_orderkey as string) as doc_id", "l_returnflag as status", "'s2' as collection_session_id",
        "cast(null as string) as metar_id",
        "l_linenumber", "l_partkey", "l_suppkey",
    )
    merged = merge.replace_upsert(
        target, source, "doc_id", ["l_linenumber", "l_partkey", "l_suppkey", "status"],
        F.expr("timestamp_ntz'2024-02-01 00:00:00'"), keep=("metar_id",),
    )
    return merged


def _revisions(spark, folder):
    """Late records of landed flights in two revisions."""
    return fx.flights(spark, folder).filter("status = 'LANDED'").selectExpr(
        "flight_number", "from_airport", "to_airport", "departure_scheduled_utc",
        "explode(array(1, 2)) as revision", "row_key",
        "departure_actual_utc as departure_final_utc",
        "arrival_scheduled_utc as planned", "delay_min as delay",
    ).selectExpr(
        "flight_number", "from_airport", "to_airport", "departure_scheduled_utc", "revision", "row_key",
        "departure_final_utc", "planned + interval '1' minute * (delay + revision) as arrival_actual_utc",
        "concat('FINAL', revision) as status_final", "delay + revision as delay_min",
    )


@query
def late_actuals(spark, folder):
    flights = fx.flights(spark, folder).select(
        "row_key", *merge.FLIGHT_KEY, "arrival_actual_utc", "status_final", "delay_min"
    )
    return merge.late_actuals(flights, _revisions(spark, folder), ["revision", "row_key"]).select(
        "row_key", "departure_final_utc", "arrival_actual_utc", "status_final", "delay_min"
    )


@query
def prediction_writeback(spark, folder):
    flights = fx.flights(spark, folder).select("row_key", "delay_prob", "delay_risk_level")
    predictions = fx.flights(spark, folder).filter("delay_min is not null").selectExpr(
        "row_key", "case when delay_min <> 0 then abs(delay_min) / 50.0D end as delay_probability",
        "case when delay_min > 20 then 'high' when delay_min > 5 then 'medium' end as risk_level",
    )
    return merge.write_back_predictions(flights, predictions, "row_key")


@query
def incremental_dim(spark, folder):
    parts = fx.table(spark, folder, "part")
    old = parts.filter("p_partkey % 5 <> 0").selectExpr("p_partkey as id", "p_name as name", "p_size as size")
    new = parts.filter("p_partkey % 3 = 0").selectExpr(
        "p_partkey as id", "upper(p_name) as name", "p_size + 100 as size"
    )
    return merge.upsert(old, new, ["id"])


@query
def upsert_latest(spark, folder):
    target = fx.table(spark, folder, "customer").selectExpr(
        "c_custkey as id", "c_mktsegment as segment", "c_acctbal as amount"
    )
    source = fx.table(spark, folder, "orders").filter("o_custkey % 2 = 0").selectExpr(
        "o_custkey as id", "o_orderpriority as segment", "o_totalprice as amount", "o_orderkey as seq"
    )
    latest = merge.last_per_key(source, ["id"], ["seq"]).drop("seq")
    return merge.upsert(target, latest, ["id"])


@query
def set_links(spark, folder):
    flights = fx.flights(spark, folder).selectExpr(
        "row_key", "case when departure_metar_fk % 2 = 0 then 'old' end as metar_id"
    )
    links = fx.flights(spark, folder).filter("arrival_taf_fk % 3 = 0").selectExpr(
        "row_key", "concat('M', departure_metar_fk) as metar_id"
    )
    return merge.set_links(flights, links, "row_key", ["metar_id"])


@query
def cascade_delete(spark, folder):
    alive = fx.metar(spark, folder).filter("wx_string is not null").select("id")
    return merge.cascade_delete(fx.sky_condition(spark, folder), "metar_fk", alive).select(
        "id", "metar_fk", "taf_fk", "sky_cover"
    )


# ---- dimensions --------------------------------------------------------------

def _carriers(spark, folder):
    """Customers seen as airlines; two-letter codes repeat."""
    return fx.table(spark, folder, "customer").selectExpr(
        "c_custkey as id",
        "concat(lower(c_mktsegment), ' air ', c_custkey % 13) as name",
        "case when c_custkey % 11 = 0 then null else concat(chr(cast(65 + c_custkey % 23 as int)),"
        " cast((c_custkey * 7) % 10 as string)) end as iata",
        "case when c_custkey % 4 = 0 then null else lpad(cast(c_custkey % 389 as string), 3, 'I') end as icao",
        "concat('NATION_', c_nationkey) as country_name",
        "case c_custkey % 3 when 0 then 'N' when 1 then 'Y' else 'y' end as active",
    )


def _nations(spark, folder):
    return fx.table(spark, folder, "nation").selectExpr(
        "n_nationkey as id", "concat('N', n_nationkey) as code", "n_name as country_name"
    )


def _brands(spark, folder):
    return fx.table(spark, folder, "supplier").selectExpr(
        "concat('Machinery AIR ', s_suppkey % 13) as Brand", "s_suppkey"
    ).groupBy("Brand").agg(F.min("s_suppkey").cast("double").alias("average_age"))


@query
def airline_dim(spark, folder):
    return dims.dim_airlines(_carriers(spark, folder), _nations(spark, folder), _brands(spark, folder))


@query
def active_flag(spark, folder):
    carriers = _carriers(spark, folder)
    previous = carriers.filter("id % 5 <> 0").selectExpr(
        "id", "case id % 4 when 0 then 'Y' when 1 then 'N' when 2 then 'Y' end as active"
    )
    return dims.active_flag(carriers.select("id", "name", "active"), previous)


@query
def active_dups(spark, folder):
    return dims.active_duplicates(_carriers(spark, folder))


def _authority(spark, folder):
    return fx.table(spark, folder, "supplier").selectExpr(
        "concat(chr(cast(65 + s_suppkey % 23 as int)), cast((s_suppkey * 7) % 10 as string)) as iata",
        "lpad(cast((s_suppkey * 3) % 389 as string), 3, 'i') as icao",
        "concat('Machinery Air ', s_suppkey % 13) as name",
    )


@query
def authority_exact(spark, folder):
    return dims.exact_authority_match(_carriers(spark, folder), _authority(spark, folder))


@query
def authority_match(spark, folder):
    return dims.authority_match(_carriers(spark, folder), _authority(spark, folder))


@query
def clear_active_dups(spark, folder):
    return dims.clear_active_duplicates(_carriers(spark, folder), _authority(spark, folder))


@query
def one_row_per_iata(spark, folder):
    return dims.one_row_per_iata(_carriers(spark, folder), _authority(spark, folder))


def _own_airports(spark, folder):
    return fx.table(spark, folder, "part").selectExpr(
        "p_partkey as id", "concat('ID', p_partkey) as ident", "lower(p_type) as type", "p_name as name",
        "p_retailprice as latitude_deg", "-p_retailprice as longitude_deg", "p_brand as iso_country",
        "'EU' as continent", "p_type as iso_region",
        "case when p_partkey % 3 = 0 then null else concat('IC', p_partkey) end as icao_code",
        "case when p_partkey % 4 < 2 then null else concat('IA', p_partkey) end as iata_code",
        "cast(null as string) as gps_code", "cast(null as string) as local_code", "p_name as municipality",
    )


def _other_airports(spark, folder):
    return fx.table(spark, folder, "customer").selectExpr(
        "case when c_custkey % 3 = 0 then null else concat('IA', c_custkey) end as iata_code",
        "concat('IC', c_custkey) as icao_code",
        "case when c_custkey % 7 <> 0 then c_name end as city",
        r"case when c_custkey % 5 = 0 then '\\N' else 'Europe/Paris' end as timezone",
        r"case when c_custkey % 2 = 0 then '\\N' else '1' end as gmt_offset",
    )


@query
def airport_dim(spark, folder):
    return dims.dim_airports(_own_airports(spark, folder), _other_airports(spark, folder))


@query
def distinct_airports(spark, folder):
    return dims.airport_iata_ids(
        dims.dim_airports(_own_airports(spark, folder), _other_airports(spark, folder))
    )


def _routes(spark, folder):
    return fx.flights(spark, folder).selectExpr(
        r"case when delay_min = 7 then '\\N' else airline_code end as airline_iata",
        "from_airport as source_airport_iata",
        r"case when delay_min = 8 then '\\N' when delay_min = 9 then 'AP99' else to_airport end as dest_airport_iata",
        r"case when status = 'LANDED' then '\\N' else 'Y' end as shared",
        "0 as stops", "flight_number as equipments",
    )


def _route_airlines(spark, folder):
    return fx.airlines(spark, folder).selectExpr("iata", "cast(substr(iata, 2) as bigint) as id")


@query
def route_dim(spark, folder):
    return dims.dim_routes(
        _routes(spark, folder), _route_airlines(spark, folder),
        fx.airports(spark, folder).selectExpr("cast(id as bigint) as id", "iata_code"),
    )


@query
def runway_semi(spark, folder):
    runways = fx.table(spark, folder, "orders").selectExpr(
        "o_orderkey as id", "cast(o_custkey % 40 as int) as airport_ref", "o_orderpriority as surface"
    )
    return dims.dim_runways(runways, fx.airports(spark, folder))


def _countries(spark, folder):
    """Part names seen as country names: many near copies of each other."""
    return fx.table(spark, folder, "part").groupBy(
        F.expr("concat(p_name, ' ', p_brand)").alias("name")
    ).agg(F.min("p_partkey").alias("id")).selectExpr("id", "concat('C', id) as code", "name")


def _country_fleet(spark, folder):
    return fx.table(spark, folder, "part").groupBy(
        F.expr("concat(upper(p_name), '-', p_type)").alias("country_name")
    ).agg(F.max("p_partkey").cast("double").alias("average_age"))


@query
def country_fuzzy(spark, folder):
    return text.similar_names(
        _countries(spark, folder), "name", _country_fleet(spark, folder), "country_name"
    )


@query
def country_match(spark, folder):
    return dims.country_matches(_countries(spark, folder), _country_fleet(spark, folder))


@query
def union_countries(spark, folder):
    return dims.dim_countries(_countries(spark, folder), _country_fleet(spark, folder))


@query
def country_anti(spark, folder):
    matched = dims.country_matches(_countries(spark, folder), _country_fleet(spark, folder))
    return _countries(spark, folder).join(matched.select("id"), "id", "left_anti")


@query
def first_seen_dedup(spark, folder):
    pulls = fx.flights(spark, folder).selectExpr(
        "airline_code as carrier", "flight_number", "cast(departure_scheduled_utc as date) as dep_date",
        "date_format(departure_scheduled_utc, 'HH:mm') as dep_time", "row_key",
    )
    return dims.first_seen(pulls, ["carrier", "flight_number", "dep_date", "dep_time"], ["row_key"])


@query
def snapshot_delta(spark, folder):
    rows = fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    new = rows.withColumn("l_returnflag", F.expr("if(l_quantity > 45, 'X', l_returnflag)"))
    return dims.snapshot_delta(rows, new)


@query
def snapshot_changed(spark, folder):
    """Digests of a file's rows, in any order, and of a copy with one column changed."""
    rows = fx.table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cast(l_quantity as long) as l_quantity", "l_returnflag"
    )
    changed = rows.withColumn("l_returnflag", F.expr("if(l_quantity > 45, 'X', l_returnflag)"))
    return dims.snapshot_digest(rows.repartition(5)).withColumn("copy", F.lit("old")).unionByName(
        dims.snapshot_digest(changed).withColumn("copy", F.lit("new"))
    )


# ---- data quality ------------------------------------------------------------

@query
def dq_unique(spark, folder):
    return quality.unique(fx.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_relationship(spark, folder):
    return quality.relationship(
        fx.flights(spark, folder), "departure_metar_fk",
        fx.metar(spark, folder), "id",
    ).select("row_key", "departure_metar_fk")


@query
def dq_accepted(spark, folder):
    return quality.accepted_values(_carriers(spark, folder), "active", ["Y", "N"]).select("id", "active")


@query
def dq_one_parent(spark, folder):
    broken = fx.sky_condition(spark, folder).withColumn(
        "taf_fk", F.expr("if(id % 7 = 0, metar_fk, taf_fk)")
    )
    return quality.one_parent(broken).select("id")


@query
def dq_not_null(spark, folder):
    return quality.not_null(_carriers(spark, folder), "iata").select("id")


@query
def dq_report(spark, folder):
    tables = {
        "flight": fx.flights(spark, folder), "metar": fx.metar(spark, folder), "taf": fx.taf(spark, folder),
        "sky": fx.sky_condition(spark, folder),
    }
    return quality.report(tables, quality.weather_checks())


@query
def dq_dimensions(spark, folder):
    airports = dims.dim_airports(_own_airports(spark, folder), _other_airports(spark, folder))
    carriers = dims.dim_airlines(_carriers(spark, folder), _nations(spark, folder), _brands(spark, folder))
    runways = fx.table(spark, folder, "orders").selectExpr("o_orderkey as id", "o_custkey * 2 as airport_ref")
    tables = {
        "countries": _nations(spark, folder), "airlines": carriers, "airports": airports,
        "routes": dims.null_markers(_routes(spark, folder)), "runways": runways,
    }
    return quality.report(tables, quality.dimension_checks())


# ---- normalisation -----------------------------------------------------------

def _moment(text):
    return F.lit(text).cast("timestamp_ntz")


LOADED, NOW = "2024-02-01 00:00:00", "2024-01-31 00:00:00"


def _texts(spark, folder):
    """Untidy numbers and times made from events."""
    return fx.table(spark, folder, "events").selectExpr(
        "event_id as id",
        "case event_id % 8 when 0 then concat(cast(event_id as string), '+') when 1 then 'VRB' when 2 then '-'"
        " when 3 then concat('-', cast(event_id as string), '.', lpad(cast(event_id % 1000 as string), 3, '0'))"
        " when 4 then concat(cast(event_id % 999 as string), '.', cast(event_id % 10 as string), '45')"
        " when 5 then '' when 6 then concat(cast(event_id % 77 as string), '-1')"
        " else concat(' ', cast(event_id % 500 as string), '.5 kt') end as number",
        "case event_id % 7 when 0 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        " when 1 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
        " when 2 then date_format(ts, 'yyyy-MM-dd HH:mm:ss') when 3 then date_format(ts, 'yyyyMMdd_HHmmss')"
        " when 4 then date_format(ts, \"yyyy-MM-dd'T'HH:mm\") when 5 then date_format(ts, 'dd/MM/yyyy')"
        " else '' end as time",
        "ts",
    )


@query
def clean_decimal(spark, folder):
    return _texts(spark, folder).select(
        "id", clean.clean_decimal("number", 2, 18).cast("double").alias("two"),
        clean.clean_decimal("number", 3, 18).cast("double").alias("three"),
    )


@query
def clean_int(spark, folder):
    return _texts(spark, folder).select(
        "id", clean.clean_integer("number", "long").alias("whole"),
        clean.lost_decimal_point("number").alias("lost_point"),
    )


@query
def clean_timestamp(spark, folder):
    return _texts(spark, folder).select("id", clean.clean_timestamp("time").alias("at"))


@query
def numeric_beside_text(spark, folder):
    return clean.with_numbers(_texts(spark, folder).selectExpr("id", "number as wind_dir_degrees", "time as wx"))


@query
def flight_id(spark, folder):
    scheduled = "date_format(departure_scheduled_utc, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    docs = fx.flights(spark, folder).selectExpr(
        "row_key", "flight_number", "if(delay_min = 3, '', from_airport) as origin", "to_airport",
        f"case when delay_min = 1 then null when delay_min = 2 then '' else {scheduled} end as scheduled",
    )
    return docs.select("row_key", normalize.flight_id(
        F.col("flight_number"), F.col("origin"), F.col("to_airport"), F.col("scheduled")
    ).alias("flight_id"))


@query
def delay_minutes(spark, folder):
    return fx.flights(spark, folder).select(
        "row_key",
        normalize.delay_minutes(F.col("departure_actual_utc"), F.col("departure_scheduled_utc")).alias("departure"),
        normalize.late_minutes(F.col("arrival_actual_utc"), F.col("arrival_scheduled_utc")).alias("arrival"),
    )


def _sky_documents(spark, folder):
    """Zero to five layers per event, some without cover."""
    return fx.table(spark, folder, "events").selectExpr(
        "concat('M', event_id) as _id",
        "transform(sequence(1, cast(event_id % 5 + 1 as int)), k -> named_struct("
        " 'sky_cover', case when (event_id + k) % 6 = 0 then '' else"
        "   element_at(array('FEW', 'SCT', 'BKN', 'OVC', 'VV'), k) end,"
        " 'cloud_base_ft_agl', concat(cast(k * 1000 as string), ' ft'),"
        " 'cloud_type', case when k = 3 then 'CB' end)) as sky_condition",
    )


@query
def sky_layers_rows(spark, folder):
    return normalize.sky_rows(_sky_documents(spark, folder)).withColumn(
        "condition_order", F.col("condition_order").cast("int")
    )


@query
def sky_layers_wide(spark, folder):
    return normalize.sky_wide(_sky_documents(spark, folder))


def _wx(spark, folder):
    """Weather strings of one or two codes, with signs and unknown parts."""
    return fx.table(spark, folder, "events").selectExpr(
        "event_id as id",
        "case when event_id % 29 = 0 then null when event_id % 31 = 0 then '' when event_id % 37 = 0 then 'CLEAR'"
        " else concat(element_at(array('+', '-', '', 'VC', 'X'), cast(event_id % 5 + 1 as int)),"
        " element_at(array('TSRA', 'SN', 'FZRA', 'FG', 'BR', 'RA', 'DZ', 'DS', 'XX', 'SQ', 'GR', 'HZ', 'PL'),"
        "   cast(event_id % 13 + 1 as int)),"
        " element_at(array('', ' BR', 'Q', '+', ' SHRA', ' IC', ' FU'), cast(event_id % 7 + 1 as int))) end as wx",
    )


@query
def wx_decode(spark, folder):
    return _wx(spark, folder).select("id", "wx", weather.decode_wx(F.col("wx")).alias("words"))


@query
def wx_severity(spark, folder):
    return _wx(spark, folder).select("id", weather.severity_class(F.col("wx")).alias("severity"))


@query
def wx_impact(spark, folder):
    parts = weather.impact(F.col("wx"))
    return _wx(spark, folder).select("id", *[c.alias(n) for n, c in parts.items()]).withColumn(
        "overall", weather.worst_impact(F.col("weather_impact"), F.lit("low"))
    )


@query
def local_to_utc(spark, folder):
    boards = fx.flights(spark, folder).selectExpr(
        "row_key", "if(delay_min = 5, 'AP77', from_airport) as from_airport",
        "date_format(departure_scheduled_utc, 'yyyy-MM-dd') as day",
        "if(delay_min = 4, '', date_format(departure_scheduled_utc, 'HH:mm')) as clock",
    )
    return zones.board_times_to_utc(
        boards, fx.airports(spark, folder), "day", {"utc": "clock"}, "from_airport"
    ).select("row_key", "utc")


@query
def expected_boards(spark, folder):
    moments = fx.metar(spark, folder).selectExpr("id", "station_id as icao_code", "observation_time as now")
    places = moments.join(fx.airports(spark, folder).select("icao_code", "iata_code", "timezone"), "icao_code")
    return zones.expected_board_hour(places, F.col("now"), 1).groupBy(
        "iata_code", "airport_timezone", "board_date", "shift", "utc_offset"
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def airport_labels(spark, folder):
    names = fx.airports(spark, folder).filter("id % 5 <> 4").selectExpr(
        "iata_code as code_iata", "icao_code", "id as row_no",
        "if(id % 3 = 0, concat('Greater Metropolitan ', airport_name), airport_name) as name",
    )
    return reference.airport_labels(fx.metar(spark, folder).select("id", "station_id"), names)


@query
def metar_feed(spark, folder):
    """Reports written as XML elements, parsed and typed again."""
    elements = _spread(fx.metar(spark, folder)).selectExpr(
        "concat('<METAR><station_id>', station_id, '</station_id><observation_time>',"
        " date_format(observation_time, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\"), '</observation_time>',"
        " if(id % 9 = 0, '', concat('<temp_c>', temp_c, '</temp_c>')),"
        " '<wind_dir_degrees>', if(id % 6 = 0, 'VRB', wind_dir_degrees), '</wind_dir_degrees>',"
        " '<wind_speed_kt>', wind_speed_kt, '</wind_speed_kt>',"
        " coalesce(concat('<visibility_statute_mi>', visibility_statute_mi, '+</visibility_statute_mi>'), ''),"
        " '<sky_condition sky_cover=\"FEW\" cloud_base_ft_agl=\"1200\"/><sky_condition sky_cover=\"BKN\"/>',"
        " coalesce(concat('<wx_string>', wx_string, '</wx_string>'), ''), '</METAR>') as element"
    )
    docs = feeds.metar_from_text(elements, "element", _moment(LOADED))
    return with_doubles(normalize.metar_rows(docs).select(
        "external_id", "observation_time", "station_id", "temp_c", "wind_dir_degrees",
        F.col("wind_speed_kt").cast("int").alias("wind_speed_kt"), "visibility_statute_mi", "wx_string",
    ))


@query
def taf_feed(spark, folder):
    """Reports of zero to three forecasts, some empty, fanned out to one row each."""
    elements = _spread(fx.taf(spark, folder)).selectExpr(
        "concat('<TAF><station_id>', station_id, '</station_id><issue_time>',"
        " date_format(issue_time, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '</issue_time>',"
        " concat_ws('', transform(if(id % 4 = 0, array(), sequence(0, cast(id % 4 as int) - 1)), k ->"
        "   if((id + k) % 5 = 0, '<forecast/>', concat('<forecast><fcst_time_from>',"
        "   date_format(fcst_time_from, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '</fcst_time_from>',"
        "   if(k = 1, '', concat('<fcst_time_to>',"
        "   date_format(coalesce(fcst_time_to, fcst_time_from), \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '</fcst_time_to>')),"
        "   '<wind_speed_kt>', wind_speed_kt, '</wind_speed_kt></forecast>')))), '</TAF>') as element"
    )
    docs = feeds.taf_from_text(elements, "element", _moment(LOADED))
    typed = normalize.taf_rows(docs)
    return typed.select(
        "external_id", "station_id", "issue_time", "fcst_time_from", "fcst_time_to",
        F.col("wind_speed_kt").cast("int").alias("wind_speed_kt"),
    )


def _spread(df):
    """Rows over all cores before text is made and parsed.

    A test file is one scan task; real pages and feeds come from many files.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _pages(spark, folder):
    """One board page per order, with one flight row and at times a code-share note."""
    return _spread(fx.table(spark, folder, "orders")).selectExpr(
        "o_orderkey as k",
        "concat('/landing/raw_', concat('A', chr(cast(65 + o_custkey % 2 as int)), 'C'), '_',"
        " if(o_orderkey % 3 = 0, 'arrival', 'departure'), '_2024-01-15_08h_20240115_081500.html') as path",
        "concat('<html><body><table class=\"x flightsTable\"><tr><th>h</th></tr><tr><td><a href=\"/f?d=2024-01-16\">FL',"
        " o_orderkey, '</a></td><td><a>Town [XYZ]</a></td><td>', o_orderstatus, '</td><td><span>08:',"
        " lpad(cast(o_orderkey % 60 as string), 2, '0'), '</span>', if(o_orderkey % 4 = 0,"
        " '<span class=\"estimatedTime depDelayed\" data-delay=\"25\">09:05 [01-16]</span>', ''),"
        " '<span class=\"gate\">G', o_orderkey % 9, '</span></td><td>10:30</td>',"
        " '<td><span>On time</span><button data-arrivaltime=\"2024-01-16T10:30:00.000\"></button></td></tr>',"
        " if(o_orderkey % 5 = 0, concat('<tr class=\"compensation-row\"><td>Operated By XX', o_orderkey,"
        " '</td></tr>'), ''), '</table>', if(o_orderkey % 50 = 7, '<span class=\"noflights\"></span>', ''),"
        " '</body></html>') as html",
    )


def _board_airports(spark, folder):
    return fx.airports(spark, folder).selectExpr(
        "case id when 0 then 'AAC' when 1 then 'ABC' when 2 then 'XYZ' end as iata_code", "timezone"
    ).filter("iata_code is not null")


@query
def board_parse(spark, folder):
    docs = boards.parse_boards(_pages(spark, folder), _board_airports(spark, folder))
    return docs.select(
        "flight_number", "from_code", "to_code", "airline", "status", "operated_by", "airport_type",
        F.col("departure.date").alias("dep_date"), F.col("departure.scheduled").alias("dep_scheduled"),
        F.col("departure.estimated").alias("dep_estimated"), F.col("departure.gate").alias("dep_gate"),
        F.col("departure.delay.is_delayed").alias("dep_is_delayed"),
        F.col("departure.delay.minutes").alias("dep_delay"),
        F.col("arrival.date").alias("arr_date"), F.col("arrival.scheduled").alias("arr_scheduled"),
    )


@query
def flight_documents(spark, folder):
    """Board pages all the way to flight table rows."""
    docs = boards.parse_boards(_pages(spark, folder), _board_airports(spark, folder))
    rows, _ = clean.split_valid(
        normalize.flight_rows(normalize.collected_flights(docs, "s1", "realtime_departures", _moment(LOADED))),
        ["flight_number", "from_airport", "to_airport"],
    )
    return rows.select(
        "flight_number", "airline_code", "from_airport", "to_airport", "departure_scheduled_utc",
        "departure_actual_utc", "arrival_scheduled_utc", "delay_min",
    )


def _listing(spark, folder):
    """Names and times of landed files made from events; some names do not fit."""
    return fx.table(spark, folder, "events").selectExpr(
        "concat('/landing/raw_', 'A', chr(cast(65 + user_id % 26 as int)), chr(cast(65 + event_id % 3 as int)), '_',"
        " if(event_id % 2 = 0, 'arrival', 'departure'), '_', date_format(ts, 'yyyy-MM-dd'), '_',"
        " date_format(ts, 'HH'), if(event_id % 11 = 0, '', 'h'), '_', date_format(ts, 'yyyyMMdd_HHmmss'), '.html') as path",
        "date_trunc('minute', ts) as modified", "event_id as length",
    ).withColumn("modified", F.col("modified").cast("timestamp_ntz"))


@query
def landing_newest(spark, folder):
    files = landing.catalog(_listing(spark, folder), _moment(NOW))
    return landing.newest_per_key(files, 240).select("airport", "type", "date", "shift", "filename")


@query
def landing_totals(spark, folder):
    return landing.totals(landing.catalog(_listing(spark, folder), _moment(NOW), board_type="arrival"))


@query
def landing_expired(spark, folder):
    return landing.expired(landing.catalog(_listing(spark, folder), _moment(NOW)), 48)


# ---- features ----------------------------------------------------------------

def _gappy(spark, folder):
    """Flights where most hours of some days have no usable final status."""
    return fx.flights(spark, folder).withColumn("status_final", F.expr(
        "case when (dayofmonth(departure_scheduled_utc) * 24 + hour(departure_scheduled_utc)) % 5 < 2 then"
        " element_at(array(' ', 'NULL', null), 1 + abs(coalesce(delay_min, 0)) % 3) else status_final end"
    ))


@query
def gap_removal(spark, folder):
    return features.remove_gaps(_gappy(spark, folder)).select("row_key", "departure_scheduled_utc")


@query
def settled_flights(spark, folder):
    return features.settled(fx.flights(spark, folder)).select("row_key")


@query
def frequency(spark, folder):
    flights = fx.flights(spark, folder).withColumn(
        "from_airport", F.expr("if(delay_min = 0, null, from_airport)")
    )
    return features.frequencies(flights, "from_airport")


@query
def visibility_class(spark, folder):
    return fx.metar(spark, folder).select(
        "id", features.visibility_class(F.col("visibility_statute_mi")).alias("visibility")
    )


@query
def severity(spark, folder):
    return fx.metar(spark, folder).select("id", features.severity(
        F.col("wind_speed_kt"), F.coalesce("wind_gust_kt", F.lit(0)),
        features.visibility_class(F.col("visibility_statute_mi")),
    ).alias("severity"))


@query
def local_time_parts(spark, folder):
    timed = features.time_features(fx.flights(spark, folder), fx.airports(spark, folder))
    return timed.select(
        "row_key", "departure_hour_local", "arrival_hour_local", "departure_dayofweek", "arrival_dayofweek",
        "departure_month", "departure_quarter", "departure_day", "flight_duration_hours", "is_rush_hour_dep",
        "is_rush_hour_arr", "is_weekend", "is_month_end", "is_month_start",
    )


@query
def target_flag(spark, folder):
    return features.target(fx.flights(spark, folder).withColumn("delay_min", F.col("delay_min").cast("double"))).select(
        "row_key", "delay"
    )


@query
def class_shares(spark, folder):
    flights = fx.flights(spark, folder).withColumn("delay_min", F.col("delay_min").cast("double"))
    return features.class_shares(features.target(flights))


def _prepared(spark, folder):
    cut = features.training_cut(fx.flights(spark, folder))
    return features.prepare(_view(spark, folder), fx.airports(spark, folder), cut=cut)


@query
def feature_frame(spark, folder):
    """The full training frame, reduced to sums per airport for comparison."""
    frame = _prepared(spark, folder)
    return frame.groupBy("from_airport").agg(
        F.count(F.lit(1)).alias("n"), F.sum("delay").alias("late"),
        F.sum("weather_severity_dep").alias("dep"), F.sum("weather_severity_arr").alias("arr"),
        F.count(F.when(F.col("overall_weather_impact") == "high", 1)).alias("high"),
        F.sum(F.col("flight_duration_minutes").cast("long")).alias("minutes"),
        F.sum(F.col("departure_delay_minutes").cast("long")).alias("shift"),
        F.max(F.round("airport_flight_count", 9)).alias("share"),
        F.sum("is_rush_hour_arr").alias("rush"),
    )


@query
def sample_rows(spark, folder):
    n = 1000
    sampled = features.sample_rows(fx.flights(spark, folder).select("row_key", "airline_code"), n, ["row_key"])
    return sampled


# ---- scores ------------------------------------------------------------------

def _scored(spark, folder):
    """Order lines as scores and outcomes: many distinct scores, some shared."""
    return fx.table(spark, folder, "lineitem").selectExpr(
        "cast(l_returnflag = 'R' as int) as label", "floor(l_extendedprice / 11) / 10000 as score",
        "l_linenumber"
    )


@query
def pr_points(spark, folder):
    return evaluation.curve_points(evaluation.curve(_scored(spark, folder)))


@query
def roc_auc(spark, folder):
    return evaluation.areas(evaluation.curve(_scored(spark, folder))).select("roc_auc")


@query
def avg_precision(spark, folder):
    return evaluation.areas(evaluation.curve(_scored(spark, folder))).select(
        F.round("pr_auc", 9).alias("pr_auc")
    )


@query
def best_threshold(spark, folder):
    return evaluation.best_threshold(evaluation.curve(_scored(spark, folder)))


@query
def risk_bands(spark, folder):
    return evaluation.risk_bands(evaluation.curve(_scored(spark, folder)))


@query
def score_metrics(spark, folder):
    return evaluation.metrics(_scored(spark, folder)).withColumn("pr_auc", F.round("pr_auc", 9))


@query
def overfit_gaps(spark, folder):
    scored = _scored(spark, folder)
    report = evaluation.overfit_gaps(
        evaluation.metrics(scored.filter("l_linenumber > 1"), 0.4),
        evaluation.metrics(scored.filter("l_linenumber = 1"), 0.4),
    )
    return report.select(*[
        F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in report.dtypes
    ])


@query
def calibration(spark, folder):
    return evaluation.calibration(_scored(spark, folder)).withColumns({
        "mean_score": F.round("mean_score", 9), "positive_rate": F.round("positive_rate", 9)
    })


@query
def brier(spark, folder):
    return evaluation.brier(_scored(spark, folder)).select(F.round("brier_score", 9).alias("brier_score"))


@query
def score_histogram(spark, folder):
    return evaluation.histogram(_scored(spark, folder))


@query
def prediction_summary(spark, folder):
    predictions = _scored(spark, folder).select(
        F.col("score").alias("delay_probability"), (F.col("score") >= 0.5).cast("int").alias("prediction"),
        evaluation.risk_level(F.col("score"), 0.3, 0.6).alias("risk_level"),
    )
    summary = evaluation.prediction_summary(predictions)
    return summary.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in summary.dtypes])


# ---- streams -----------------------------------------------------------------

def _event_stream(spark, folder, name="events"):
    """One driver table as a stream of files."""
    schema = fx.table(spark, folder, name).schema
    return jobs.read_new(spark, folder, "parquet", schema, pattern=f"{name}.parquet")


def _appended(spark, stream, label):
    base = run_dir(spark, label)
    jobs.append_available(stream, f"{base}/table", f"{base}/progress")
    return spark.read.parquet(f"{base}/table")


@query
def stream_dedup(spark, folder):
    doubled = _event_stream(spark, folder).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    unique = jobs.first_copies(doubled, ["event_id"], "ts").select("event_id", "user_id", "event_type")
    return _appended(spark, unique, "dedup")


@query
def stream_hourly(spark, folder):
    windows = jobs.settled_windows(
        _event_stream(spark, folder), "ts", "1 hour", jobs.SETTLING,
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"),
    )
    return _appended(spark, windows, "hourly")


@query
def stream_latest(spark, folder):
    reports = _event_stream(spark, folder).selectExpr(
        "concat('ZZ', lpad(user_id % 25, 2, '0')) as station_id", "event_id as id", "ts as observation_time"
    )
    base = run_dir(spark, "latest")
    empty = spark.createDataFrame([], "station_id string, metar_id long, observation_time timestamp_ntz")
    empty.write.parquet(jobs.version_path(f"{base}/table", 0))
    jobs.merge_available(
        jobs.latest_reports(reports), f"{base}/table", f"{base}/progress", jobs.keep_latest, mode="update"
    )
    return jobs.read_latest(spark, f"{base}/table")


@query
def stream_late_actuals(spark, folder):
    """Orders as stored flights, order lines as late records arriving in files."""
    base = run_dir(spark, "actuals")
    stored = fx.table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as string) as flight_number", "'AAA' as from_airport", "'BBB' as to_airport",
        "cast(o_orderdate as timestamp_ntz) as departure_scheduled_utc",
        "cast(null as timestamp_ntz) as departure_final_utc", "cast(null as timestamp_ntz) as arrival_actual_utc",
        "cast(null as string) as status_final", "cast(null as int) as delay_min",
    )
    stored.write.parquet(jobs.version_path(f"{base}/table", 0))
    dates = fx.table(spark, folder, "orders").selectExpr("o_orderkey", "o_orderdate")
    late = _event_stream(spark, folder, "lineitem").join(dates, F.expr("l_orderkey = o_orderkey")).selectExpr(
        "cast(l_orderkey as string) as flight_number", "'AAA' as from_airport", "'BBB' as to_airport",
        "cast(o_orderdate as timestamp_ntz) as departure_scheduled_utc",
        "cast(o_orderdate as timestamp_ntz) + interval '1' minute * l_linenumber as departure_final_utc",
        "cast(null as timestamp_ntz) as arrival_actual_utc", "l_returnflag as status_final",
        "cast(l_quantity as int) as delay_min", "l_linenumber", "l_partkey", "l_suppkey",
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "status_final", "delay_min"]
    jobs.merge_available(late, f"{base}/table", f"{base}/progress", jobs.actuals_step(order))
    return jobs.read_latest(spark, f"{base}/table").select(
        "flight_number", "departure_final_utc", "status_final", "delay_min"
    )


@query
def stream_best_taf(spark, folder):
    """Order lines arrive as flights and get their best forecast batch by batch."""
    base = run_dir(spark, "linked")
    spark.createDataFrame([], "flight_key string, taf_id long").write.parquet(
        jobs.version_path(f"{base}/table", 0)
    )
    arrivals = _event_stream(spark, folder, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as flight_key",
        "concat('AP', lpad(l_suppkey % 25, 2, '0')) as to_airport", "cast(null as string) as operated_by",
        "timestamp_ntz'2024-01-01 00:00:00' + interval '1' minute * cast((l_orderkey * 7 + l_partkey) % 43200 as int)"
        " as arrival_scheduled_utc",
    )
    jobs.merge_available(
        arrivals, f"{base}/table", f"{base}/progress",
        jobs.link_step(fx.taf(spark, folder), fx.airports(spark, folder), ["flight_key"], ["arrival_scheduled_utc"]),
    )
    return jobs.read_latest(spark, f"{base}/table")


# ---- models ------------------------------------------------------------------

def _frame(spark, folder):
    return stored(_prepared(spark, folder).select("f_id", *features.MODEL_COLUMNS), "frame")


def _train(spark, folder, name, **params):
    return model.train(_frame(spark, folder), ["f_id"], name, **params)


@query
def train_logistic(spark, folder):
    return _train(spark, folder, "logistic_regression").test_metrics


@query
def train_tree_importance(spark, folder):
    trained = _train(spark, folder, "decision_tree")
    return evaluation.cumulative_importance(model.feature_importance(spark, trained.fitted))


@query
def train_boosted_overfit(spark, folder):
    """The boosted preset of 100 rounds, as it is; the others differ in rounds, step and sampling."""
    return _train(spark, folder, "lightgbm").overfit


@query
def predicted_risk(spark, folder):
    """Train, score every flight of the view and count risk levels per airline."""
    cut = features.training_cut(fx.flights(spark, folder))
    # Read for training, for scoring and for the airlines of the scored flights.
    view, airports = stored(_view(spark, folder).select("f_id", *features.VIEW_COLUMNS), "view"), fx.airports(spark, folder)
    frame = stored(features.prepare(view, airports, cut=cut).select("f_id", *features.MODEL_COLUMNS), "frame")
    trained = model.train(frame, ["f_id"], "random_forest")
    # Scored with the frequencies of training, as a stored model would.
    predictions = model.predict_flights(trained, view, airports, cut.tables)
    return predictions.join(view.select("f_id", "airline_code"), "f_id").groupBy("airline_code", "risk_level").agg(
        F.count(F.lit(1)).alias("flights"), F.avg("delay_probability").alias("mean_probability")
    )
