"""DuckDB statements for the report queries."""

from .prelude import with_tables as w


def pct(part, whole, places=2):
    return f"round(100.0 * {part} / {whole}, {places})"


def cent_mean(column):
    """Mean of a column held in hundredths, rounded half away from zero to two places."""
    s, n = f"sum({column})", f"count({column})"
    return f"(case when {s} < 0 then -1 else 1 end * ((2 * abs({s}) + {n}) // (2 * {n}))) / 100.0::double"


def int_mean(column):
    s, n = f"sum({column} * 100)", f"count({column})"
    return f"((2 * {s} + {n}) // (2 * {n})) / 100.0::double"


RANK = "case {c} when 'low' then 1 when 'medium' then 2 when 'high' then 3 end"
CM_T, CM_V, CM_D, IM_W = cent_mean("temp_cents"), cent_mean("vis_cents"), cent_mean("dew_cents"), int_mean("wind_speed_kt")

TOP_AIRPORTS = f"""select station_id as airport, count(*) as observations, {CM_T} as avg_temp,
  {IM_W} as avg_wind_speed, {CM_V} as avg_visibility
from metar group by 1 order by observations desc, airport"""

AIRLINE_STATS = """ranked as (select airline_code as airline, count(*) as flights,
  round(100.0 * count(case when delay_min >= 10 then 1 end) / count(*), 2) as delay_rate
  from flight where airline_code is not null group by 1 order by 2 desc, 1 limit {n}),
named as (select r.airline, a.name as airline_name, r.flights, r.delay_rate
  from ranked r left join airline a on r.airline = a.iata)"""

SQL = {
    "flight_stats": w("flight") + """
select count(*) as total_flights, count(case when delay_min >= 10 then 1 end) as delayed_flights,
  round(100.0 * count(case when delay_min >= 10 then 1 end) / count(*), 2) as delay_rate,
  coalesce(round(avg(case when delay_min >= 10 then delay_min end), 2), 0.0) as avg_delay,
  count(delay_prob) as flights_with_ml,
  round(100.0 * count(case when delay_prob > 0.5 and delay_min >= 10 or delay_prob <= 0.5 and delay_min < 10
    then 1 end) / count(delay_prob), 2) as ml_accuracy,
  cast(min(departure_scheduled_utc) as date) as date_min, cast(max(departure_scheduled_utc) as date) as date_max
from flight where cast(departure_scheduled_utc as date) between date '2024-01-03' and date '2024-01-27'""",
    "daily_stats": w("flight") + """
select cast(departure_scheduled_utc as date) as date, count(*) as total,
  count(case when delay_min >= 10 then 1 end) as delayed,
  round(100.0 * count(case when delay_min >= 10 then 1 end) / count(*), 2) as delay_rate
from flight group by 1 order by 1""",
    "hourly_stats": w("flight") + """
select cast(hour(departure_scheduled_utc) as int) as hour, count(*) as flights,
  round(100.0 * count(case when delay_min >= 10 then 1 end) / count(*), 2) as delay_rate
from flight group by 1 order by 1""",
    "airline_stats": w("flight", "airline", extra=AIRLINE_STATS.format(n=3)) + """
select * from named order by delay_rate, airline""",
    "worst_hour": w("flight", "airline", extra=AIRLINE_STATS.format(n=15) + """,
hours as (select hour(departure_scheduled_utc) as hour,
  round(100.0 * count(case when delay_min >= 10 then 1 end) / count(*), 2) as rate from flight group by 1)""") + """
select cast((select hour from hours order by rate desc, hour limit 1) as int) as worst_hour,
  (select max(rate) from hours) as worst_hour_rate,
  (select coalesce(airline_name, airline) from named order by delay_rate desc, airline limit 1) as riskiest_airline,
  (select max(delay_rate) from named) as riskiest_airline_rate""",
    "ml_confusion": w("flight", extra="""c as (select
  count(case when delay_prob > 0.5 and delay_min >= 10 then 1 end) as tp,
  count(case when delay_prob <= 0.5 and delay_min < 10 then 1 end) as tn,
  count(case when delay_prob > 0.5 and delay_min < 10 then 1 end) as fp,
  count(case when delay_prob <= 0.5 and delay_min >= 10 then 1 end) as fn from flight where delay_prob is not null)""") + """
select tp, tn, fp, fn, round_even((tp + tn) / (tp + tn + fp + fn) * 100.0, 2) as accuracy,
  round_even(tp / (tp + tn + fp + fn) * 100.0, 1) as tp_pct, round_even(tn / (tp + tn + fp + fn) * 100.0, 1) as tn_pct,
  round_even(fp / (tp + tn + fp + fn) * 100.0, 1) as fp_pct, round_even(fn / (tp + tn + fp + fn) * 100.0, 1) as fn_pct
from c""",
    "risk_distribution": w("flight") + f"""
select delay_risk_level, count(*) as count from flight where delay_risk_level is not null
group by 1 order by {RANK.format(c='delay_risk_level')}""",
    "ml_reliability": w("flight") + f"""
select delay_risk_level as risk_level, count(*) as total_vols,
  count(case when delay_min >= 15 then 1 end) as vrais_retards,
  count(case when delay_min < 15 or delay_min is null then 1 end) as vols_a_l_heure,
  round_even(count(case when delay_min >= 15 then 1 end) / count(*) * 100.0, 1) as taux_retard_reel
from flight where delay_risk_level is not null group by 1""",
    "filter_options": w("flight") + """
select distinct 'airline' as kind, airline_code as value, cast(null as bigint) as count from flight
where airline_code is not null
union all select 'risk_level', delay_risk_level, count(*) from flight where delay_risk_level is not null group by 2""",
    "search_flights": w("flight", "metar", "airport", "airline") + """
select f.row_key, f.flight_number, f.from_airport, af.city as from_city, af.airport_name as from_airport_name,
  f.to_airport, ap.city as to_city, ap.airport_name as to_airport_name, f.airline_code, al.name as airline_name,
  strftime(f.departure_scheduled_utc, '%Y-%m-%d %H:%M:%S') as departure_scheduled_utc,
  strftime(f.arrival_scheduled_utc, '%Y-%m-%d %H:%M:%S') as arrival_scheduled_utc,
  strftime(f.arrival_actual_utc, '%Y-%m-%d %H:%M:%S') as arrival_actual_utc,
  coalesce(cast(f.delay_min as double), epoch_us(f.arrival_actual_utc - f.arrival_scheduled_utc) / 60000000.0) as delay_min,
  f.delay_prob, f.delay_risk_level, m.visibility_statute_mi as dep_visibility_mi,
  m.flight_category as dep_flight_category, m.temp_c as dep_temp_c, m.wind_speed_kt as dep_wind_speed_kt,
  m.wx_string as dep_weather_conditions
from flight f left join metar m on f.departure_metar_fk = m.id
left join airport af on f.from_airport = af.iata_code left join airport ap on f.to_airport = ap.iata_code
left join airline al on f.airline_code = al.iata
where f.departure_scheduled_utc >= timestamp '2024-01-05' and f.departure_scheduled_utc <= timestamp '2024-01-26'
  and f.flight_number ilike '%a1%' and f.delay_risk_level in ('low', 'medium') and f.delay_prob is not null
order by f.departure_scheduled_utc desc, f.row_key limit 10000""",
    "search_delayed": w("flight", "metar", "airport", "airline") + """
select f.row_key, f.flight_number, f.from_airport, af.city as from_city, af.airport_name as from_airport_name,
  f.to_airport, ap.city as to_city, ap.airport_name as to_airport_name, f.airline_code, al.name as airline_name,
  strftime(f.departure_scheduled_utc, '%Y-%m-%d %H:%M:%S') as departure_scheduled_utc,
  strftime(f.arrival_scheduled_utc, '%Y-%m-%d %H:%M:%S') as arrival_scheduled_utc,
  strftime(f.arrival_actual_utc, '%Y-%m-%d %H:%M:%S') as arrival_actual_utc,
  coalesce(cast(f.delay_min as double), epoch_us(f.arrival_actual_utc - f.arrival_scheduled_utc) / 60000000.0) as delay_min,
  f.delay_prob, f.delay_risk_level, m.visibility_statute_mi as dep_visibility_mi,
  m.flight_category as dep_flight_category, m.temp_c as dep_temp_c, m.wind_speed_kt as dep_wind_speed_kt,
  m.wx_string as dep_weather_conditions
from flight f left join metar m on f.departure_metar_fk = m.id
left join airport af on f.from_airport = af.iata_code left join airport ap on f.to_airport = ap.iata_code
left join airline al on f.airline_code = al.iata
where f.airline_code = 'A3' and f.delay_min >= 10 and f.delay_prob > 0.5
order by f.departure_scheduled_utc desc, f.row_key limit 500""",
    "meteo_stats": w("metar", "taf", "sky_condition") + """
select (select count(*) from metar) as total_metar, (select count(*) from taf) as total_taf,
  (select count(*) from sky_condition) as total_sky_conditions,
  (select count(distinct station_id) from metar) as airports_metar,
  (select count(distinct station_id) from taf) as airports_taf,
  (select cast(min(observation_time) as date) from metar) as date_min_metar,
  (select cast(max(observation_time) as date) from metar) as date_max_metar,
  (select cast(min(issue_time) as date) from taf) as date_min_taf,
  (select cast(max(issue_time) as date) from taf) as date_max_taf""",
    "flight_categories": w("metar") + """
select flight_category as condition, count(*) as count,
  round(100.0 * count(*) / cast(sum(count(*)) over () as bigint), 2) as percentage
from metar where flight_category is not null group by 1""",
    "weather_conditions": w("metar") + """
select wx_string as condition, count(*) as count,
  round(100.0 * count(*) / cast(sum(count(*)) over () as bigint), 2) as percentage
from metar where wx_string is not null
  and cast(observation_time as date) between date '2024-01-02' and date '2024-01-20'
group by 1 order by 2 desc, 1 limit 20""",
    "top_airports": w("metar") + TOP_AIRPORTS + " limit 20",
    "station_extremes": w("metar", extra=f"""t as ({TOP_AIRPORTS} limit 200),
lo as (select *, row_number() over (order by avg_visibility, airport) as p from t where avg_visibility is not null),
hi as (select *, row_number() over (order by avg_wind_speed desc, airport) as p from t where avg_wind_speed is not null)""") + """
select airport, observations, avg_temp, avg_wind_speed, avg_visibility, cast(case when p <= 20 then p end as int) as rank,
  'low_visibility' as kind from lo where p <= 20 or airport = 'ZZ07'
union all select airport, observations, avg_temp, avg_wind_speed, avg_visibility,
  cast(case when p <= 20 then p end as int), 'high_wind' from hi where p <= 20 or airport = 'ZZ07'""",
    "visibility_bins": w("metar") + """
select case when visibility_statute_mi < 1 then '< 1 mi' when visibility_statute_mi < 3 then '1-3 mi'
  when visibility_statute_mi < 5 then '3-5 mi' when visibility_statute_mi < 10 then '5-10 mi' else '>= 10 mi' end
  as visibility_range, count(*) as count, min(visibility_statute_mi) as min_vis
from metar where visibility_statute_mi is not null group by 1""",
    "wind_bins": w("metar") + """
select case when wind_speed_kt < 5 then '< 5 kt' when wind_speed_kt < 10 then '5-10 kt'
  when wind_speed_kt < 15 then '10-15 kt' when wind_speed_kt < 20 then '15-20 kt'
  when wind_speed_kt < 25 then '20-25 kt' else '>= 25 kt' end as wind_range,
  count(*) as count, min(wind_speed_kt) as min_wind
from metar where wind_speed_kt is not null group by 1""",
    "visibility_timeline": w("metar") + f"""
select cast(observation_time as date) as date, {CM_V} as avg_visibility, count(*) as observations
from metar where visibility_statute_mi is not null and station_id = 'ZZ03' group by 1""",
    "temperature_stats": w("metar") + f"""
select cast(observation_time as date) as date, {CM_T} as avg_temp, {CM_D} as avg_dewpoint,
  count(*) as observations from metar group by 1""",
}
