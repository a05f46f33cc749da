"""DuckDB statements for file sources, loads, splits and metadata."""

from .model import FRAME, SCORED
from .normalize import BOARD, LISTING, ZONE
from .prelude import with_tables as w

LABELLED = """lab as (select distinct row_key, airline_code, from_airport, cast(coalesce(delay_min, 0) > 15 as int) as delay from flight),
placed as (select *, ('0x' || substr(md5(concat('{seed}', '|', row_key)), 1, 15))::bigint as h from lab),
ranked as (select *, row_number() over (partition by delay order by h, row_key) as r, count(*) over (partition by delay) as n from placed)"""

STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"

DOCS = f"""docs as (select *, case when delay_min = 7 then '' else flight_number end as num,
  case when delay_min = 8 then null else concat('M', departure_metar_fk) end as metar_id,
  case when delay_min = 9 then null else concat('T', arrival_taf_fk) end as taf_id from flight),
chosen as (select * from docs where departure_terminal not in ('T2', 'T3') and operated_by is null
  and metar_id is not null and taf_id is not null)"""

CHOSEN = f"""{DOCS},
used_metar as (select id, external_id, case when id % 13 = 0 then '' else station_id end as station_id, date_trunc('second', observation_time)
    as observation_time, wx_string from metar where external_id in (select metar_id from chosen)),
used_taf as (select id, external_id, station_id, date_trunc('second', issue_time) as issue_time from taf
    where external_id in (select taf_id from chosen))"""

YEAR = """year as (select e.*, a.timezone from (select event_id as id, event_id % 25 as place,
  timestamp '2024-01-01' + interval '1' day * cast(event_id % 366 as int) + interval '1' minute * cast((event_id * 37) % 1440 as int) as moment
  from events) e join airport a on a.id = e.place)"""

BRANCH = """case when arriving then 'XYZ' else airport end"""

def weather(end, column):
    """Impact columns of a weather string."""
    u = f"coalesce(upper({column}), '')"

    def has(*codes):
        return "(" + " or ".join(f"contains({u}, '{c}')" for c in codes) + ")"

    level = f"""case when {has('TS', 'GR', 'SQ', 'SS', 'DS', 'FG')} then 4
      when {has('FZ')} and {has('RA', 'SN')} or {has('SN')} or {has('RA')} and {has('HVY', '+')} then 3
      when {has('RA', 'DZ', 'BR')} then 2 else 1 end"""
    return level, f"""(['none', 'low', 'medium', 'high'])[{level}] as {end}_weather_impact,
  case when {has('TS')} then 'THUNDERSTORM' when {has('GR')} then 'HAIL' when {has('SS', 'DS')} then 'DUST_STORM'
    when {has('SQ')} then 'THUNDERSTORM' when {has('FG')} then 'FOG' when {has('FZ')} and {has('RA', 'SN')} then 'ICING'
    when {has('SN')} then 'SNOW' when {has('RA')} and {has('HVY', '+')} then 'RAIN'
    when {has('RA', 'DZ', 'BR')} then 'LIGHT_WEATHER' else 'CLEAR' end as {end}_weather_simplified,
  {has('TS', 'SQ', 'GR')} as {end}_has_convective, {has('FZ', 'IC', 'PE')} as {end}_has_icing,
  {has('FG', 'BR')} as {end}_visibility_affected, {has('TS', 'SQ')} as {end}_wind_affected"""


def miles(column):
    return f"""case when {column} is null then null when {column} < 5 then concat('<', cast(floor({column}) as int) + 1) else '>=5' end as {column}"""


def severe(prefix):
    return f"""cast(coalesce({prefix}wind_speed_kt, 0) > 20 as int) + cast(coalesce({prefix}wind_gust_kt, 0) > 30 as int)
    + cast(coalesce({prefix}visibility_statute_mi < 2, false) as int)"""


DEP_LEVEL, DEP = weather("dep", "wx_string")
ARR_LEVEL, ARR = weather("arr", "t_wx_string")
RUSH = "in (7, 8, 17, 18, 19) as int)"

FEATURE_ROWS = FRAME.rstrip() + f""",
lines as (select airline_code, round(count(*) / (select count(*) from cut), 9) as share from cut group by 1),
placed as (select f.*, s.share as airport_flight_count, l.share as airline_flight_count, m.wind_dir_degrees as dep_dir,
    t.wind_dir_degrees as arr_dir, f.departure_scheduled_utc + interval '1' minute * zd.off as dl, f.arrival_scheduled_utc + interval '1' minute * za.off as al
  from cut f join shares s on f.from_airport = s.from_airport join lines l on f.airline_code = l.airline_code
  join z zd on f.from_airport = zd.code join z za on f.to_airport = za.code
  left join metar m on f.departure_metar_fk = m.id left join taf t on f.arrival_taf_fk = t.id
  where f.status <> 'CANCELLED')
select f_id, cast(coalesce(delay_min, 0) > 15 as int) as delay, cast(coalesce(delay_min, 0) as double) as delay_min,
  cast(coalesce(wind_speed_kt, 0) as double) as wind_speed_kt, cast(dep_dir as double) as wind_dir_degrees,
  cast(coalesce(wind_gust_kt, 0) as double) as wind_gust_kt, cast(coalesce(t_wind_speed_kt, 0) as double) as t_wind_speed_kt,
  cast(arr_dir as double) as t_wind_dir_degrees, cast(coalesce(t_wind_gust_kt, 0) as double) as t_wind_gust_kt,
  (epoch_us(departure_actual_utc) - epoch_us(departure_scheduled_utc)) / 60000000.0::double as departure_delay_minutes,
  (epoch_us(arrival_scheduled_utc) - epoch_us(departure_scheduled_utc)) / 60000000.0::double as flight_duration_minutes,
  airport_flight_count, airline_flight_count, {severe('')} as weather_severity_dep, {severe('t_')} as weather_severity_arr,
  round_even((epoch_us(arrival_scheduled_utc) - epoch_us(departure_scheduled_utc)) / 3600000000.0, 1) as flight_duration_hours,
  cast(hour(dl) as int) as departure_hour_local, cast(hour(al) as int) as arrival_hour_local,
  cast(isodow(dl) - 1 as int) as departure_dayofweek, cast(isodow(al) - 1 as int) as arrival_dayofweek,
  cast(month(dl) as int) as departure_month, cast(quarter(dl) as int) as departure_quarter, cast(day(dl) as int) as departure_day,
  cast(hour(dl) {RUSH} as is_rush_hour_dep, cast(hour(al) {RUSH} as is_rush_hour_arr,
  cast(isodow(dl) >= 6 as int) as is_weekend, cast(day(dl) > 25 as int) as is_month_end, cast(day(dl) <= 5 as int) as is_month_start,
  {DEP}, {ARR}, (['none', 'low', 'medium', 'high'])[greatest({DEP_LEVEL}, {ARR_LEVEL})] as overall_weather_impact,
  {miles('visibility_statute_mi')}, {miles('t_visibility_statute_mi')}, msc_sky_cover, tsc_sky_cover
from placed"""

SQL = {
    "feature_rows": FEATURE_ROWS,
    "seed_load": """select c_custkey as key, c_name as name, case when c_custkey % 9 = 0 then 'NA' else c_mktsegment end as segment,
  case when c_custkey % 7 <> 0 then c_nationkey end as nation from customer""",
    "headerless_carriers": """select cast(c_custkey as varchar) as id, concat('Line, ', c_name) as name, cast(null as varchar) as alias,
  case when c_custkey % 3 <> 0 then concat('C', c_custkey % 50) end as iata, c_mktsegment as icao, 'NA' as callsign,
  cast(c_nationkey as varchar) as country_name, case when c_custkey % 2 = 0 then 'Y' else 'N' end as active from customer""",
    "airport_file": """
select concat('K', c_custkey) as code_iata, concat('Z', c_custkey) as icao_code, case when c_nationkey % 2 = 0 then 'Europe/Paris' else 'UTC' end as timezone,
  case when c_custkey % 2 = 0 then c_mktsegment else c_name end as name from customer where c_custkey % 2 = 0 or c_custkey % 7 <> 0""",
    "first_airports": """
select concat('K', c_custkey) as code_iata from customer where c_custkey % 2 = 0 or c_custkey % 7 <> 0
order by c_custkey % 2 = 0, c_custkey limit 10""",
    "restore_metar": w("metar") + """
select id, external_id, station_id, date_trunc('second', observation_time) as observation_time, wind_dir_degrees, temp_c, dewpoint_c,
  wind_speed_kt, wind_gust_kt, visibility_statute_mi, altim_in_hg, wx_string, metar_type, flight_category from metar""",
    "restore_counts": w("flight", "metar", "taf", "sky_condition") + """
select 'flight' as name, count(*) as rows from flight union all select 'metar', count(*) from metar
union all select 'taf', count(*) from taf union all select 'sky_condition', count(*) from sky_condition
union all select 'sky_cover_reference', 9""",
    "json_documents": """select event_id, user_id, event_type, value, props as detail_props, strftime(ts, '%Y-%m-%d') as detail_day,
  true as provenance_source_file, timestamp '2024-02-01' as provenance_imported_at from events""",
    "json_combined": """select source_file, flight_type, flight_date, documents from (values ('combined_arrivals_2025-10-01.json', 'arrivals', '2025-10-01', 0),
  ('combined_departures_2025-10-02.json', 'departures', '2025-10-02', 1), ('combined_x.json', 'unknown', 'unknown', 2))
  f(source_file, flight_type, flight_date, part), lateral (select count(*) as documents from nation where n_nationkey % 3 = part)""",
    "json_sink": w("metar") + "select id, station_id, wx_string, wind_speed_kt from metar",
    "paged_reference": """select concat('A', c_custkey) as "AirlineID", c_mktsegment as "AirlineID_ICAO", c_name as "Name" from customer""",
    "flight_csv": w("flight") + """
select row_key, airline_code, from_airport, status_final, case when delay_min <> 3 then cast(delay_min as double) end as delay_min,
  case when delay_min is null or delay_min <> 4 then departure_scheduled_utc end as departure_scheduled_utc from flight""",
    "metar_files": w("metar") + f"""
select concat(station_id, '_', {STAMP.format('observation_time')}) as external_id, date_trunc('second', observation_time) as observation_time,
  concat('RAW ', id) as raw_text, station_id, case when id % 6 <> 0 then wind_dir_degrees end as wind_dir_degrees, wind_speed_kt,
  wind_gust_kt, case when id % 9 <> 0 then temp_c end as temp_c, dewpoint_c, visibility_statute_mi, altim_in_hg,
  1000 + id % 50 + 0.25::double as sea_level_pressure_mb, case when id % 4 = 0 then 21.5::double end as maxt_c,
  case when id % 4 = 1 then (-3)::double end as mint_c, case when id % 5 = 0 then 0.125::double end as pcp3hr_in,
  case when id % 5 = 1 then 0.006::double end as pcp6hr_in, case when id % 5 = 2 then 1::double end as pcp24hr_in,
  case when id % 5 = 3 then 0.01::double end as precip_in, case when id % 8 = 0 then (-1.5)::double end as three_hr_pressure_tendency_mb,
  flight_category, metar_type, case when id % 7 = 0 then 300 end as vert_vis_ft, wx_string, 'METAR' as data_type,
  'metar-feed' as source, timestamp '2024-02-01' as file_downloaded_at,
  cast(11 + (id % 9 <> 0)::int + (wind_gust_kt is not null)::int + (visibility_statute_mi is not null)::int
    + (flight_category is not null)::int + (id % 4 < 2)::int + (id % 5 < 4)::int + (id % 8 = 0)::int + (id % 7 = 0)::int
    + (wx_string is not null)::int as int) as total_fields
from metar""",
    "taf_files": w("taf") + f"""
select concat_ws('_', concat('S', id), {STAMP.format('issue_time')}, {STAMP.format('fcst_time_from')}, {STAMP.format('fcst_time_to')}, 'f0')
  as external_id, concat('S', id) as station_id, date_trunc('second', issue_time) as issue_time,
  case when id % 3 = 0 then date_trunc('second', issue_time) end as bulletin_time, fcst_time_from as valid_time_from,
  fcst_time_to as valid_time_to, case when id % 11 = 0 then 'AMD' end as remarks, fcst_time_from, fcst_time_to, wind_dir_degrees,
  wind_speed_kt, wind_gust_kt, visibility_statute_mi, case when id % 6 = 0 then 400 end as vert_vis_ft, wx_string,
  29.92::double as altim_in_hg, change_indicator, case when id % 4 = 0 then 30 end as probability,
  case when id % 5 = 0 then 20.56::double end as max_temp_c, case when id % 5 = 1 then (-1)::double end as min_temp_c,
  concat('RAW ', id) as raw_text from taf""",
    "flight_rows_full": f"""with {BOARD}, zone as (
  select case n_nationkey when 0 then 'AAC' when 1 then 'ABC' when 2 then 'XYZ' end as code, {ZONE} as off from nation n where n_nationkey < 3),
f as (select *, {BRANCH} as a, case when arriving then airport else 'XYZ' end as b from page)
select concat('FL', o_orderkey) as flight_number, 'FL' as airline_code, a as from_airport, b as to_airport, cast(null as varchar) as aircraft_code,
  cast(null as varchar) as departure_metar_external_id, cast(null as varchar) as arrival_taf_external_id,
  cast(null as bigint) as departure_metar_fk, cast(null as bigint) as arrival_taf_fk,
  timestamp '2024-01-16 08:00:00' + interval '1' minute * (o_orderkey % 60 - za.off) as departure_scheduled_utc,
  case when delayed then timestamp '2024-01-16 09:05:00' - interval '1' minute * za.off
    else timestamp '2024-01-16 08:00:00' + interval '1' minute * (o_orderkey % 60 - za.off) end as departure_actual_utc,
  '' as departure_terminal, concat('G', o_orderkey % 9) as departure_gate,
  timestamp '2024-01-16 10:30:00' - interval '1' minute * zb.off as arrival_scheduled_utc,
  timestamp '2024-01-16 10:30:00' - interval '1' minute * zb.off as arrival_actual_utc, '' as arrival_terminal, '' as arrival_gate,
  'On time' as status, cast(null as varchar) as status_final, cast(null as int) as delay_min, 'realtime_departures' as collection_type,
  timestamp '2024-02-01' as collected_at, '' as source, '1.0' as script_version, 's1' as collection_session_id, false as is_updated,
  0 as update_count
from f join zone za on f.a = za.code join zone zb on f.b = zb.code""",
    "unreadable_boards": f"""with {BOARD} select false as unreadable, count(*) as rows from page""",
    "landing_lookup": f"""with {LISTING}, newest as (select airport, type, date, shift, max({{'m': modified, 'f': filename, 'a': age}}) as v
  from files group by all),
wanted as (select distinct 'A' || chr(cast(65 + user_id % 26 as int)) || chr(cast(65 + event_id % 4 as int)) as airport, 'arrival' as type,
  strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%H') as shift from events)
select w.*, case when v is null then 'missing' when v.a > 86400 then 'too old' else 'found' end as status, v.f as filename
from wanted w left join newest using (airport, type, date, shift)""",
    "landing_missing": f"""with {LISTING}, expected as (select distinct 'A' || chr(cast(65 + user_id % 26 as int)) || chr(cast(65 + event_id % 4 as int))
  as iata_code, strftime(ts, '%Y-%m-%d') as board_date, strftime(ts, '%H') as shift from events)
select * from expected e where not exists (select 1 from files f where f.airport = e.iata_code and f.type = 'departure'
  and f.date = e.board_date and f.shift = e.shift)""",
    "landing_order": f"""with {LISTING} select stamp as timestamp, filename from files order by stamp desc, filename limit 10""",
    "load_flights": w("flight", extra=DOCS) + """
select distinct num as flight_number, from_airport, to_airport, departure_scheduled_utc
from chosen where num <> ''""",
    "load_metar": w("flight", "metar", extra=CHOSEN.split(",\nused_taf")[0]) + """
select external_id, station_id, observation_time, wx_string from used_metar where station_id <> ''""",
    "load_taf": w("flight", "metar", "taf", extra=CHOSEN) + "select external_id, station_id, issue_time from used_taf",
    "load_sky": w("flight", "metar", "taf", extra=CHOSEN) + """
select external_id, 'FEW' as sky_cover, cast(k * 100 as int) as cloud_base_ft_agl, cast(k as int) as condition_order
from (select id, external_id from used_metar where station_id <> '' union all select id, external_id from used_taf), range(1, 4) r(k)
where k <= id % 3 + 1""",
    "load_rejected": w("flight", "metar", "taf", extra=CHOSEN) + """
select 'metar' as name, (select count(*) from used_metar where station_id = '') as rows union all select 'taf', 0
union all select 'flight', (select count(*) from chosen where num = '')""",
    "rebuilt_version": w("metar") + "select id, station_id, wx_string from metar",
    "shared_ids": "select event_id % 997 as id, count(*) as keys from events group by 1 having count(*) > 1",
    "surrogate_ids": w("flight") + """
select n as ids, n as keys from (select count(distinct (flight_number, from_airport, to_airport, departure_scheduled_utc)) as n from flight)""",
    "fleet_ages": """select concat(p_brand, '-', p_partkey) as brand, case when p_size % 10 <> 0 then round(p_size / 4, 2) end as average_age,
  case when p_size % 7 <> 0 then cast(p_partkey as int) end as place from part""",
    "split_parts": w("flight", extra=LABELLED.format(seed=42)) + "select row_key, delay from ranked where r <= floor(n * 0.25)",
    "cv_folds": w("flight", extra=LABELLED.format(seed=43)) + "select row_key, cast(floor((r - 1) * 5 / n) as bigint) as fold from ranked",
    "class_weights": w("flight", extra=LABELLED.format(seed=42)) + """
select delay, count(*) as rows, round((select count(*) from lab) / (2 * count(*)), 9) as weight from lab group by 1""",
    "imbalance_ratio": w("flight", extra=LABELLED.format(seed=42)) + """
select count(case when delay = 0 then 1 end) / count(case when delay = 1 then 1 end) as ratio from lab""",
    "category_levels": w("flight", extra=LABELLED.format(seed=42) + """,
counts as (select 'airline_code' as name, airline_code as level, count(*) as n from lab group by 2
  union all select 'from_airport', from_airport, count(*) from lab group by 2),
places as (select *, row_number() over (partition by name order by n desc, level) as p, count(*) over (partition by name) as levels from counts)""") + """
select name, cast(row_number() over (partition by name order by level) - 1 as int) as place, level from places where levels <= 20 or p <= 19
union all select distinct name, 19::int, '(infrequent)' from places where levels > 20""",
    "scored_rows": FRAME + """
select airline_code, count(*) as rows, count(case when delay_min > 15 then 1 end) as late, max(departure_scheduled_utc) as newest
from cut where status <> 'CANCELLED' group by 1""",
    "residual_histogram": f"""with {SCORED}, r as (select label - floor(score * 64) / 64 as v from scored),
b as (select min(v) as lo, max(v) as hi from r)
select cast(least(floor((v - lo) / ((hi - lo) / 16)), 15) as bigint) as bin, count(*) as n from r, b group by 1""",
    "stream_latest_files": w("metar") + """
select station_id, arg_max(id, {'t': observation_time, 'id': id}) as metar_id, max(observation_time) as observation_time from metar group by 1""",
    "stream_daily": """with d as (select cast(date_trunc('day', ts) as timestamp) as window_start, count(*) as n,
  cast(sum(user_id) as bigint) as users from events group by 1)
select * from d where window_start + interval '1' day <= (select max(ts) - interval '24' hour from events)""",
    "session_selection": w("flight", extra=DOCS) + "select row_key as _id, metar_id, taf_id from chosen",
    "linked_documents": w("flight", "metar", "taf", "airport", extra="""own as (select * from flight where operated_by is null),
known as (select station_id, arg_max(id, {'t': date_trunc('second', observation_time), 'id': external_id}) as id,
  arg_max(external_id, {'t': date_trunc('second', observation_time), 'id': external_id}) as external_id from metar where id % 13 <> 0 group by 1),
linked as (select f.row_key, k.external_id as metar_id from own f left join airport a on f.from_airport = a.iata_code
  left join known k on k.station_id = a.icao_code),
every as (select f.row_key, l.metar_id from flight f left join (select row_key, any_value(metar_id) as metar_id from linked group by 1) l using (row_key))""") + """
select metar_id is not null as metar_associated, case when metar_id is not null then timestamp '2024-02-01' end as metar_association_date,
  count(*) as rows, count(distinct metar_id) as reports, 0::bigint as odd from every group by 1, 2""",
    # The second file comes after the first, so its record wins.
    "stream_actuals_by_day": """
with l as (select l_orderkey, least(l_linenumber, 3) as slice, max({'a': l_partkey, 'b': l_suppkey, 'c': l_returnflag, 'd': cast(l_quantity as int)}) as v
  from lineitem group by 1, 2),
last as (select l_orderkey, arg_max(v, slice) as v from l group by 1)
select cast(o_orderkey as varchar) as flight_number, timestamp '2024-01-01' + interval '1' hour * cast(o_orderkey % 480 as int)
  as departure_scheduled_utc, v.c as status_final, v.d as delay_min from orders left join last on o_orderkey = l_orderkey""",
    "local_times_year": w("airport", extra=YEAR) + """
select id, timezone(timezone, timezone('UTC', moment)) as local from year""",
    "board_times_year": w("airport", extra=YEAR) + """
select id, timezone('UTC', timezone(timezone, date_trunc('day', moment) + interval '1' hour * cast(4 + id % 20 as int)
  + interval '1' minute * minute(moment))) as utc from year""",
    "scored_and_stored": w("flight") + """
select row_key as id, status_final is null as scored, status_final is null as has_level from flight""",
    "nearest_vectors": """with b as (select p_size % 12 as x, p_partkey % 13 as y, p_partkey % 7 as z, count(*) as copies,
  cast(sum(case when p_partkey % 3 = 0 then 1 else 0 end) as bigint) as positives from part group by 1, 2, 3),
d as (select s_suppkey as qid, b.*, (s_nationkey % 12 - x) ** 2 + (s_suppkey % 13 - y) ** 2 + (s_suppkey % 7 - z) ** 2 as square
  from supplier, b),
o as (select *, coalesce(sum(copies) over (partition by qid order by square, x, y, z rows between unbounded preceding and 1 preceding), 0) as ahead
  from d)
select qid, round(sqrt(square), 9) as distance, copies, positives from o where ahead < 5""",
}
