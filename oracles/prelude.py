"""The derived tables of ``aeroledger.fixtures`` as DuckDB SQL."""

T0 = "timestamp '2024-01-01 00:00:00'"
MINUTE = "cast((l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 43200 as int)"

TABLES = {
    "flight0": f"""
select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as row_key,
  concat('A', substr(o_orderpriority, 1, 1), l_partkey % 500) as flight_number,
  concat('A', substr(o_orderpriority, 1, 1)) as airline_code,
  concat('AP', lpad(cast(s_nationkey as varchar), 2, '0')) as from_airport,
  concat('AP', lpad(cast(c_nationkey as varchar), 2, '0')) as to_airport,
  cast(null as varchar) as aircraft_code,
  l_orderkey as departure_metar_fk, l_partkey as arrival_taf_fk,
  {T0} + interval '1' minute * {MINUTE} as departure_scheduled_utc,
  {T0} + interval '1' minute * ({MINUTE} + 60 + cast(l_partkey % 600 as int)) as arrival_scheduled_utc,
  case when l_returnflag = 'N' then null else cast(l_quantity as int) - 10 end as delay_min,
  case when l_returnflag = 'N' then null else cast(l_quantity as int) - 15 end as departure_shift,
  round(l_discount * 10, 4) as delay_prob,
  case when l_linenumber = 7 then null when l_discount < 0.03 then 'low'
       when l_discount < 0.07 then 'medium' else 'high' end as delay_risk_level,
  case o_orderstatus when 'P' then 'SCHEDULED' when 'O' then 'CANCELLED' else 'LANDED' end as status,
  case when l_returnflag = 'N' then null else 'LANDED' end as status_final,
  case when l_suppkey % 5 = 0 then concat('XX', l_suppkey) end as operated_by,
  concat('T', l_linenumber) as departure_terminal, concat('G', l_suppkey) as departure_gate,
  cast(null as varchar) as arrival_terminal, cast(null as varchar) as arrival_gate
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join supplier on l_suppkey = s_suppkey""",
    "flight": """
select * exclude (departure_shift),
  departure_scheduled_utc + interval '1' minute * departure_shift as departure_actual_utc,
  arrival_scheduled_utc + interval '1' minute * delay_min as arrival_actual_utc
from flight0""",
    "event_v": "select *, cast(round(value * 100) as bigint) as v from events",
    "metar0": """
select event_id as id, concat('M', event_id) as external_id,
  concat('ZZ', lpad(cast(user_id % 25 as varchar), 2, '0')) as station_id, ts as observation_time,
  cast((event_id * 10) % 360 as varchar) as wind_dir_degrees,
  (v % 4000) - 500 as temp_cents, (v % 4000) - 800 as dew_cents,
  cast((v % 4000) - 500 as double) / 100 as temp_c, cast((v % 4000) - 800 as double) / 100 as dewpoint_c,
  cast(v % 35 as int) as wind_speed_kt,
  case when event_id % 3 = 0 then cast(v % 35 + 10 as int) end as wind_gust_kt,
  case when event_id % 17 <> 0 then v % 1200 end as vis_cents,
  case when event_id % 17 <> 0 then cast(v % 1200 as double) / 100 end as visibility_statute_mi,
  cast(2900 + v % 150 as double) / 100 as altim_in_hg,
  case event_type when 'click' then '-RA' when 'view' then 'FG' when 'purchase' then 'TSRA'
    when 'error' then '+SN' end as wx_string,
  case when event_id % 2 = 0 then 'METAR' else 'SPECI' end as metar_type
from event_v""",
    "metar": """
select *, case when visibility_statute_mi is null then null when visibility_statute_mi < 1 then 'LIFR'
  when visibility_statute_mi < 3 then 'IFR' when visibility_statute_mi < 5 then 'MVFR' else 'VFR' end
  as flight_category
from metar0""",
    "taf": """
select event_id as id, concat('T', event_id) as external_id,
  concat('ZZ', lpad(cast(user_id % 25 as varchar), 2, '0')) as station_id, ts as issue_time,
  date_trunc('hour', ts) as fcst_time_from,
  case when event_id % 10 = 0 then null else date_trunc('hour', ts)
    + interval '1' hour * cast(1 + event_id % 12 as int) end as fcst_time_to,
  case event_type when 'click' then 'FM' when 'view' then 'BECMG' when 'purchase' then 'TEMPO'
    when 'signup' then 'PROB' end as change_indicator,
  cast((event_id * 20) % 360 as int) as wind_dir_degrees, cast(event_id % 40 as int) as wind_speed_kt,
  case when event_id % 4 = 0 then cast(event_id % 40 + 5 as int) end as wind_gust_kt,
  cast(event_id % 700 as double) / 100 as visibility_statute_mi,
  case event_type when 'click' then 'BR' when 'view' then 'SHRA' when 'purchase' then 'FZRA' end as wx_string
from events""",
    "sky_condition": """
select event_id * 8 + k as id, event_id as metar_fk, cast(null as bigint) as taf_fk,
  (['FEW','SCT','BKN','OVC'])[k] as sky_cover, cast(1000 * k as int) as cloud_base_ft_agl,
  case when k = 4 then 'CB' end as cloud_type, cast(k as int) as condition_order
from events, range(1, 5) r(k) where k <= event_id % 5
union all
select event_id * 8 + 4 + k, null, event_id, (['FEW','SCT','BKN','OVC'])[k], cast(1000 * k as int),
  case when k = 4 then 'CB' end, cast(k as int)
from events, range(1, 4) r(k) where k <= event_id % 4""",
    "airport": """
select n_nationkey as id, concat('AP', lpad(cast(n_nationkey as varchar), 2, '0')) as iata_code,
  concat('ZZ', lpad(cast(n_nationkey as varchar), 2, '0')) as icao_code,
  (['Europe/Paris','America/New_York','Asia/Tokyo','UTC','Australia/Sydney'])[n_regionkey + 1] as timezone,
  concat(n_name, ' International Airport') as airport_name, n_name as city
from nation""",
    "airline": """
select distinct concat('A', substr(o_orderpriority, 1, 1)) as iata, substr(o_orderpriority, 3) as name,
  case when cast(substr(o_orderpriority, 1, 1) as int) % 2 = 1 then 'Y' else 'N' end as active
from orders""",
}

NEEDS = {"flight": ["flight0"], "metar0": ["event_v"], "metar": ["event_v", "metar0"]}


def with_tables(*names: str, extra: str = "") -> str:
    """``WITH`` clause that defines the named tables and what they read."""
    wanted: list[str] = []
    for name in names:
        for part in [*NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    parts = [f"{name} as ({TABLES[name].strip()})" for name in wanted]
    if extra:
        parts.append(extra.strip())
    return "with " + ",\n".join(parts) + "\n"
