"""DuckDB statements for the association queries."""

from .prelude import with_tables as w

BEST_TAF = """candidates as (
  select f.row_key, t.id,
    case t.change_indicator when 'FM' then 1 when 'BECMG' then 2 when 'TEMPO' then 3 when 'PROB' then 4 else 5 end as p,
    case when t.fcst_time_to is null then 9e18 else epoch_us(t.fcst_time_to) - epoch_us(t.fcst_time_from) end as len,
    case when t.fcst_time_to is null then 2.0 * (epoch_us(f.arrival_scheduled_utc) - epoch_us(t.fcst_time_from))
      else abs(2.0 * epoch_us(f.arrival_scheduled_utc) - epoch_us(t.fcst_time_from) - epoch_us(t.fcst_time_to)) end as dist
  from (select distinct to_airport, arrival_scheduled_utc, concat(to_airport, '|', arrival_scheduled_utc) as row_key
        from flight where operated_by is null) f
  join airport a on f.to_airport = a.iata_code
  join taf t on t.station_id = a.icao_code and f.arrival_scheduled_utc >= t.fcst_time_from
    and (t.fcst_time_to is null or f.arrival_scheduled_utc <= t.fcst_time_to)),
chosen as (select row_key, arg_min(id, {'p': p, 'len': len, 'dist': dist, 'id': id}) as taf_id
  from candidates group by 1)"""

LATEST = """latest as (select station_id, arg_max(id, {'t': observation_time, 'id': id}) as metar_id
  from metar group by 1)"""

WIDE = """
select f.row_key as f_id, f.flight_number, f.from_airport, f.to_airport, f.airline_code, f.departure_metar_fk,
  f.arrival_taf_fk, f.departure_scheduled_utc, f.arrival_scheduled_utc, f.delay_min, f.status, f.status_final,
  m.station_id as m_station_id, m.observation_time, m.temp_c, m.wind_speed_kt, m.wind_gust_kt,
  m.visibility_statute_mi, m.flight_category, m.wx_string, ms.sky_cover as msc_sky_cover,
  mr.d as msc_sky_cover_description, ms.cloud_base_ft_agl as msc_cloud_base_ft_agl,
  t.station_id as t_station_id, t.fcst_time_from, t.fcst_time_to, t.wind_speed_kt as t_wind_speed_kt,
  t.visibility_statute_mi as t_visibility_statute_mi, t.wx_string as t_wx_string, t.change_indicator,
  ts.sky_cover as tsc_sky_cover, tr.d as tsc_sky_cover_description
from flight f left join metar m on f.departure_metar_fk = m.id
left join sky_condition ms on ms.metar_fk = m.id and ms.condition_order = 1
left join ref mr on ms.sky_cover = mr.c
left join taf t on f.arrival_taf_fk = t.id
left join sky_condition ts on ts.taf_fk = t.id and ts.condition_order = 1
left join ref tr on ts.sky_cover = tr.c"""
REF = "ref as (select * from (values ('FEW', 'Peu de nuages'), ('SCT', 'Nuages épars')) r(c, d))"

SQL = {
    "wide_view": w("flight", "metar", "taf", "sky_condition", extra=REF) + WIDE,
    "flights_by_ids": w("flight", "metar", "taf", "sky_condition", extra=REF) + """
select f.row_key as f_id, f.flight_number, m.wx_string, t.change_indicator, ms.sky_cover as msc_sky_cover
from flight f left join metar m on f.departure_metar_fk = m.id
left join sky_condition ms on ms.metar_fk = m.id and ms.condition_order = 1
left join taf t on f.arrival_taf_fk = t.id
where f.status_final is null""",
    "latest_metar": w("flight", "metar", "airport", extra=LATEST) + """
select f.row_key, l.metar_id, l.metar_id is not null as metar_associated
from flight f left join airport a on f.from_airport = a.iata_code
left join latest l on l.station_id = a.icao_code where f.operated_by is null""",
    "best_taf": w("flight", "taf", "airport", extra=BEST_TAF) + """
select f.row_key, c.taf_id, c.taf_id is not null as taf_associated
from flight f left join chosen c on c.row_key = concat(f.to_airport, '|', f.arrival_scheduled_utc)
where f.operated_by is null""",
    "best_taf_valid": w("flight", "taf", "airport", extra=BEST_TAF.replace(
        "join taf t on", "join (select * from taf where fcst_time_to >= timestamp '2024-01-15 06:00:00'"
        " or fcst_time_to is null) t on")) + """
select f.row_key, c.taf_id, c.taf_id is not null as taf_associated
from flight f left join chosen c on c.row_key = concat(f.to_airport, '|', f.arrival_scheduled_utc)
where f.operated_by is null""",
    "fk_resolution": w("flight", "metar", "taf") + """
select f.row_key, coalesce(case when f.departure_metar_fk % 3 = 0 then f.departure_metar_fk end, m.id) as departure_metar_fk,
  t.id as arrival_taf_fk
from flight f left join metar m on m.external_id = concat('M', f.departure_metar_fk)
left join taf t on t.external_id = concat('T', f.arrival_taf_fk * 2)""",
    "referenced_metar": w("flight", "metar") + """
select m.id, m.station_id from metar m
where m.id in (select departure_metar_fk from flight where operated_by is null)""",
    "sky_parent": w("metar", "sky_condition") + """
select s.id, m.id as metar_fk, s.sky_cover, s.condition_order
from sky_condition s join metar m on m.external_id = concat('M', s.metar_fk * 2) where s.metar_fk is not null""",
}
