"""DuckDB statements for the normalisation queries."""

from .prelude import with_tables as w

# Weather codes and their wording, stated here again so that a slip in the engine's table shows.
WX_WORDS = {
    "MI": "Mince (shallow)",
    "BC": "Bancs (patches)",
    "PR": "Partiel (partial)",
    "DR": "Chasse basse (low drifting)",
    "BL": "Chasse elevee (blowing)",
    "SH": "Averses (showers)",
    "TS": "Orage (thunderstorm)",
    "FZ": "Givrant (freezing)",
    "RE": "Recent",
    "VC": "Au voisinage (vicinity)",
    "RA": "Pluie (rain)",
    "DZ": "Bruine (drizzle)",
    "SN": "Neige (snow)",
    "SG": "Neige en grains (snow grains)",
    "IC": "Cristaux de glace (ice crystals)",
    "PL": "Granules de glace (ice pellets)",
    "GR": "Grele (hail >= 5mm)",
    "GS": "Gresil (small hail < 5mm)",
    "UP": "Precipitation inconnue (unknown)",
    "FG": "Brouillard (fog, vis < 1 km)",
    "BR": "Brume (mist, 1-5 km vis)",
    "HZ": "Brume seche (haze)",
    "FU": "Fumee (smoke)",
    "VA": "Cendres volcaniques (volcanic ash)",
    "DU": "Poussiere etendue (dust)",
    "SA": "Sable (sand)",
    "PY": "Embruns (spray)",
    "SQ": "Grain (squall)",
    "PO": "Tourbillons de sable/poussiere",
    "DS": "Tempete de sable (dust storm)",
    "SS": "Tempete de sable (sandstorm)",
    "FC": "Trombe/tornade (funnel cloud)",
    "+": "Fort (heavy)",
    "-": "Faible (light)",
}
CLEAR_SKY = "Ciel degage / Pas de phenomene"

TEXTS = """texts as (select event_id as id,
  case event_id % 8 when 0 then concat(event_id, '+') when 1 then 'VRB' when 2 then '-'
    when 3 then concat('-', event_id, '.', lpad(cast(event_id % 1000 as varchar), 3, '0'))
    when 4 then concat(event_id % 999, '.', event_id % 10, '45') when 5 then ''
    when 6 then concat(event_id % 77, '-1') else concat(' ', event_id % 500, '.5 kt') end as number,
  case event_id % 7 when 0 then 's' when 1 then 's' when 2 then 's' when 3 then 's' when 4 then 'm' end as unit, ts from events)"""


def number(places):
    kept = "regexp_replace(number, '[^0-9.\\-]', '', 'g')"
    return f"cast(round_even(try_cast(case when {kept} not in ('', '-') then {kept} end as decimal(38,18)), {places}) as double)"


WX = """wxs as (select event_id as id, case when event_id % 29 = 0 then null when event_id % 31 = 0 then ''
  when event_id % 37 = 0 then 'CLEAR' else concat((['+', '-', '', 'VC', 'X'])[event_id % 5 + 1],
  (['TSRA', 'SN', 'FZRA', 'FG', 'BR', 'RA', 'DZ', 'DS', 'XX', 'SQ', 'GR', 'HZ', 'PL'])[event_id % 13 + 1],
  (['', ' BR', 'Q', '+', ' SHRA', ' IC', ' FU'])[event_id % 7 + 1]) end as wx from events)"""


def has(*codes):
    return "(" + " or ".join(f"contains(u, '{c}')" for c in codes) + ")"


WORD_MAP = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in WX_WORDS.items()) + "}"
PAIRS = "|".join(k for k in WX_WORDS if len(k) == 2)

ZONE = """case n.n_regionkey when 0 then 60 when 1 then -300 when 2 then 540 when 3 then 0 else 660 end"""

BOARD = """page as (select *, concat('A', chr(cast(65 + o_custkey % 2 as int)), 'C') as airport,
  o_orderkey % 3 = 0 as arriving, o_orderkey % 4 = 0 as delayed from orders where o_orderkey % 50 <> 7)"""

LISTING = """listing as (select 'A' || chr(cast(65 + user_id % 26 as int)) || chr(cast(65 + event_id % 3 as int)) as airport,
  case when event_id % 2 = 0 then 'arrival' else 'departure' end as type, strftime(ts, '%Y-%m-%d') as date,
  strftime(ts, '%H') as shift, strftime(ts, '%Y%m%d_%H%M%S') as stamp, date_trunc('minute', ts) as modified
  from events where event_id % 11 <> 0),
files as (select *, concat('raw_', airport, '_', type, '_', date, '_', shift, 'h_', stamp, '.html') as filename,
  epoch_us(timestamp '2024-01-31') / 1e6 - epoch_us(modified) / 1e6 as age from listing)"""

LAYERS = """layers as (select event_id, cast(k as int) as k, case when (event_id + k) % 6 = 0 then '' else
  (['FEW', 'SCT', 'BKN', 'OVC', 'VV'])[k] end as cover from events, range(1, 6) r(k) where k <= event_id % 5 + 1)"""

SQL = {
    "clean_decimal": f"with {TEXTS} select id, {number(2)} as two, {number(3)} as three from texts",
    "clean_int": f"""with {TEXTS} select id, try_cast(nullif(nullif(regexp_replace(number, '[^0-9\\-]', '', 'g'), ''), '-') as bigint)
  as whole, regexp_matches(number, '[0-9]\\.[0-9]') as lost_point from texts""",
    "clean_timestamp": f"""with {TEXTS} select id, case unit when 's' then date_trunc('second', ts)
  when 'm' then date_trunc('minute', ts) end as at from texts""",
    "numeric_beside_text": f"""with {TEXTS} select id, number as wind_dir_degrees,
  case event_id % 7 when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
    when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S') when 3 then strftime(ts, '%Y%m%d_%H%M%S')
    when 4 then strftime(ts, '%Y-%m-%dT%H:%M') when 5 then strftime(ts, '%d/%m/%Y') else '' end as wx,
  case when number <> 'VRB' then try_cast(number as double) end as wind_dir_degrees_num
  from (select *, id as event_id from texts)""",
    "flight_id": w("flight") + """
select row_key, concat_ws('_', flight_number, case when delay_min = 3 then null else from_airport end, to_airport,
  case when delay_min in (1, 2) then 'UNKNOWN_TIME' else strftime(departure_scheduled_utc, '%Y%m%d_%H%M') end) as flight_id
from flight""",
    "delay_minutes": w("flight") + """
select row_key, cast(trunc((epoch_us(departure_actual_utc) - epoch_us(departure_scheduled_utc)) / 60000000.0) as int) as departure,
  case when delay_min is not null then greatest(delay_min, 0) end as arrival from flight""",
    "sky_layers_rows": f"""with {LAYERS} select concat('M', event_id) as external_id, cover as sky_cover,
  cast(k * 1000 as int) as cloud_base_ft_agl, case when k = 3 then 'CB' end as cloud_type, k as condition_order
  from layers where k <= 4 and cover <> ''""",
    "sky_layers_wide": f"""with {LAYERS} select concat('M', event_id) as external_id,
  """ + ", ".join(f"max(case when k = {i} then cover end) as sky_condition_sky_cover{i}, "
                  f"max(case when k = {i} then cast(k * 1000 as int) end) as sky_condition_cloud_base_ft_agl{i}"
                  for i in range(1, 5)) + " from layers group by event_id",
    "wx_decode": f"""with {WX}, s as (select *, left(wx, 1) as sign,
  case when left(wx, 1) in ('+', '-') then substr(wx, 2) else wx end as body from wxs),
c as (select *, regexp_extract_all(body, '({PAIRS}|[+\\-]$)') as codes from s)
select id, wx, case when wx is null or wx in ('', 'CLEAR') then '{CLEAR_SKY}' when len(codes) = 0 then wx
  else concat(case sign when '+' then 'Fort ' when '-' then 'Faible ' else '' end,
    array_to_string(list_transform(codes, lambda x: {WORD_MAP}[x]), ' + ')) end as words from c""",
    "wx_severity": f"""with {WX}, s as (select id, wx, coalesce(wx, '') as u from wxs) select id,
  case when wx is null or wx in ('', 'CLEAR') then 'clear' when {has('TS', '+', 'FZ')} then 'storm'
    when {has('SN', 'GR', 'PL', 'IC')} then 'snow' when {has('RA', 'DZ', 'SH')} then 'rain'
    when {has('FG', 'BR', 'HZ', 'FU')} then 'fog' else 'other' end as severity from s""",
    "wx_impact": f"""with {WX}, s as (select id, coalesce(upper(wx), '') as u from wxs),
l as (select *, case when {has('TS', 'GR', 'SQ', 'SS', 'DS')} then 4 when {has('FG')} then 4
    when {has('FZ')} and {has('RA', 'SN')} or {has('SN')} or {has('RA')} and {has('HVY', '+')} then 3
    when {has('RA', 'DZ', 'BR')} then 2 else 1 end as n from s)
select id, (['none', 'low', 'medium', 'high'])[n] as weather_impact,
  (['none', 'low', 'medium', 'high'])[greatest(n, 2)] as overall,
  case when {has('TS')} then 'THUNDERSTORM' when {has('GR')} then 'HAIL' when {has('SS', 'DS')} then 'DUST_STORM'
    when {has('SQ')} then 'THUNDERSTORM' when {has('FG')} then 'FOG' when {has('FZ')} and {has('RA', 'SN')} then 'ICING'
    when {has('SN')} then 'SNOW' when {has('RA')} and {has('HVY', '+')} then 'RAIN'
    when {has('RA', 'DZ', 'BR')} then 'LIGHT_WEATHER' else 'CLEAR' end as weather_simplified,
  {has('TS', 'SQ', 'GR')} as has_convective, {has('FZ', 'IC', 'PE')} as has_icing,
  {has('FG', 'BR')} as visibility_affected, {has('TS', 'SQ')} as wind_affected from l""",
    # January only: each zone has one offset in the data.
    "local_to_utc": w("flight") + f"""
select f.row_key, case when f.delay_min is null or f.delay_min not in (4, 5)
  then f.departure_scheduled_utc - interval '1' minute * ({ZONE}) end as utc
from flight f join nation n on f.from_airport = concat('AP', lpad(cast(n.n_nationkey as varchar), 2, '0'))""",
    "expected_boards": w("metar", "airport") + f"""
select iata_code, timezone as airport_timezone, strftime(target, '%Y-%m-%d') as board_date, strftime(target, '%H') as shift,
  case off when 60 then '1:00:00' when -300 then '-1 day, 19:00:00' when 540 then '9:00:00' when 0 then '0:00:00'
    else '11:00:00' end as utc_offset, count(*) as n
from (select a.iata_code, a.timezone, {ZONE} as off, date_trunc('hour', m.observation_time + interval '1' minute * ({ZONE}))
    + interval '1' hour * (case when minute(m.observation_time) < 30 then 0 else 1 end) as target
  from metar m join airport a on m.station_id = a.icao_code join nation n on n.n_nationkey = a.id) group by all""",
    "airport_labels": w("metar", "airport", extra="""named as (select icao_code, iata_code,
  case when id % 3 = 0 then concat('Greater Metropolitan ', city) else city end as s from airport where id % 5 <> 4)""") + """
select m.id, m.station_id, coalesce(concat(s, ' (', station_id, '/', iata_code, ')'), station_id) as label,
  case when s is null then station_id when length(s) > 20 then left(s, 18) || '..' else s end as short
from (select id, station_id, s, iata_code from metar left join named on station_id = icao_code) m""".replace(
        "concat(s, ' (', station_id, '/', iata_code, ')')", "s || ' (' || station_id || '/' || iata_code || ')'"),
    "metar_feed": w("metar") + """
select concat(station_id, '_', strftime(observation_time, '%Y-%m-%dT%H:%M:%S.%gZ')) as external_id,
  date_trunc('second', observation_time) as observation_time, station_id,
  case when id % 9 <> 0 then temp_c end as temp_c, case when id % 6 <> 0 then wind_dir_degrees end as wind_dir_degrees,
  wind_speed_kt, visibility_statute_mi, wx_string from metar""",
    "taf_feed": w("taf", extra="""stamped as (select *, strftime(issue_time, '%Y-%m-%dT%H:%M:%SZ') as i,
  strftime(fcst_time_from, '%Y-%m-%dT%H:%M:%SZ') as f,
  strftime(coalesce(fcst_time_to, fcst_time_from), '%Y-%m-%dT%H:%M:%SZ') as t from taf)""") + """
select concat(station_id, '_', i, '_base') as external_id, station_id, date_trunc('second', issue_time) as issue_time,
  cast(null as timestamp) as fcst_time_from, cast(null as timestamp) as fcst_time_to, cast(null as int) as wind_speed_kt
from stamped where id % 4 = 0 or id % 4 = 1 and id % 5 = 0
union all
select concat_ws('_', station_id, i, f, case when k <> 1 then t end, concat('f', k)), station_id,
  date_trunc('second', issue_time), fcst_time_from, case when k <> 1 then coalesce(fcst_time_to, fcst_time_from) end, wind_speed_kt
from stamped, range(0, 3) r(k) where k < id % 4 and (id + k) % 5 <> 0""",
    "board_parse": f"""with {BOARD} select concat('FL', o_orderkey) as flight_number,
  case when arriving then 'XYZ' else airport end as from_code, case when arriving then airport else 'XYZ' end as to_code,
  o_orderstatus as airline, 'On time' as status,
  case when o_orderkey % 5 = 0 then concat('XX', o_orderkey) end as operated_by,
  case when arriving then 'arrival' else 'departure' end as airport_type, '2024-01-16' as dep_date,
  concat('08:', lpad(cast(o_orderkey % 60 as varchar), 2, '0')) as dep_scheduled,
  case when delayed then '09:05' else concat('08:', lpad(cast(o_orderkey % 60 as varchar), 2, '0')) end as dep_estimated,
  concat('G', o_orderkey % 9) as dep_gate, delayed as dep_is_delayed, case when delayed then 25 else 0 end as dep_delay,
  '2024-01-16' as arr_date, '10:30' as arr_scheduled from page""",
    "flight_documents": f"""with {BOARD}, zone as (
  select case n_nationkey when 0 then 'AAC' when 1 then 'ABC' when 2 then 'XYZ' end as code, {ZONE} as off from nation n
  where n_nationkey < 3),
f as (select *, case when arriving then 'XYZ' else airport end as a, case when arriving then airport else 'XYZ' end as b from page)
select concat('FL', o_orderkey) as flight_number, 'FL' as airline_code, a as from_airport, b as to_airport,
  timestamp '2024-01-16 08:00:00' + interval '1' minute * (o_orderkey % 60 - za.off) as departure_scheduled_utc,
  case when delayed then timestamp '2024-01-16 09:05:00' - interval '1' minute * za.off
    else timestamp '2024-01-16 08:00:00' + interval '1' minute * (o_orderkey % 60 - za.off) end as departure_actual_utc,
  timestamp '2024-01-16 10:30:00' - interval '1' minute * zb.off as arrival_scheduled_utc, cast(null as int) as delay_min
from f join zone za on f.a = za.code join zone zb on f.b = zb.code""",
    "landing_newest": f"""with {LISTING}, n as (select airport, type, date, shift, max({{'m': modified, 'f': filename, 'a': age}}) as v
  from files group by all) select airport, type, date, shift, v.f as filename from n where v.a <= 864000""",
    "landing_totals": f"""with {LISTING} select count(*) as total_files, count(distinct airport) as airports,
  count(distinct date) as dates, max(round(age / 3600, 1)) as oldest_file_age_hours,
  min(round(age / 3600, 1)) as newest_file_age_hours from files where type = 'arrival'""",
    "landing_expired": f"""with {LISTING} select '/landing/' || filename as path, filename,
  round(age / 3600, 1) as age_hours from files where round(age / 3600, 1) > 48""",
}
