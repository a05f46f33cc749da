"""DuckDB statements for the streaming queries: the batch result of the same data."""

from .associate import BEST_TAF
from .prelude import with_tables as w

STREAM_FLIGHT = """flight as (select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as flight_key,
  concat('AP', lpad(cast(l_suppkey % 25 as varchar), 2, '0')) as to_airport, cast(null as varchar) as operated_by,
  timestamp '2024-01-01 00:00:00' + interval '1' minute * cast((l_orderkey * 7 + l_partkey) % 43200 as int) as arrival_scheduled_utc
  from lineitem),
"""

SQL = {
    "stream_dedup": "select event_id, user_id, event_type from events",
    # Windows are final once they end 24 hours before the newest event.
    "stream_hourly": """select date_trunc('hour', ts) as window_start, count(*) as n, max(event_id) as last_id from events
group by 1 having window_start + interval '1' hour <= (select max(ts) - interval '24' hour from events)""",
    "stream_latest": w("metar") + """
select station_id, arg_max(id, {'t': observation_time, 'id': id}) as metar_id, max(observation_time) as observation_time
from metar group by 1""",
    "stream_late_actuals": """
with late as (select l_orderkey, max({'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey, 'd': l_returnflag,
  'e': cast(l_quantity as int)}) as v from lineitem group by 1)
select cast(o_orderkey as varchar) as flight_number,
  cast(o_orderdate as timestamp) + interval '1' minute * l.v.a as departure_final_utc, l.v.d as status_final, l.v.e as delay_min
from orders left join late l on o_orderkey = l_orderkey""",
    "stream_best_taf": w("taf", "airport", extra=STREAM_FLIGHT + BEST_TAF) + """
select distinct f.flight_key, c.taf_id from flight f left join chosen c on c.row_key = concat(f.to_airport, '|', f.arrival_scheduled_utc)""",
}
SQL["stream_best_taf_files"] = SQL["stream_best_taf"]
