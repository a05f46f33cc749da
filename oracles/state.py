"""DuckDB statements for states, copies, checks while writing, and SQL functions."""

from .merge import SQL as MERGE
from .merge import grams
from .normalize import BOARD
from .normalize import SQL as NORMALIZE
from .prelude import with_tables as w


def _count(name, source, bad):
    return f"select '{name}' as \"check\", count(*) filter ({bad}) as violations from {source}"


CHECKS = [
    ("sky.one_parent", "(select *, case when id % 3 = 0 then id else taf_fk end as t from sky_condition)", "(metar_fk is null) = (t is null)"),
    ("flight.delay_risk_level not_null", "flight", "delay_risk_level is null"),
    ("flight.status accepted", "flight", "status not in ('LANDED', 'SCHEDULED')"),
    ("metar.flight_category not_null", "metar", "flight_category is null"),
    ("taf.change_indicator accepted", "taf", "change_indicator not in ('FM', 'BECMG')"),
]

SQL = {
    "stream_station_state": """
select concat('U', user_id % 997) as station_id, arg_max(event_id, {'t': ts, 'i': event_id}) as metar_id, max(ts) as observation_time,
  max(ts) + interval 24 hour <= (select max(ts) from events) as ended
from events group by 1""",
    "stream_joined_actuals": """
select cast(l_orderkey as varchar) as flight_number, concat(l_returnflag, l_linenumber, '-', l_partkey, '-', l_suppkey) as status_final,
  cast(l_quantity as int) as delay_min
from lineitem join orders on o_orderkey = l_orderkey where l_partkey % 60 <= 48""",
    "snapshot_tree_delta": MERGE["snapshot_delta"],
    "upsert_bucketed": MERGE["upsert_counters"],
    "written_checks": w("flight", "metar", "taf", "sky_condition") + "\nunion all ".join(_count(*c) for c in CHECKS),
    "metar_checked": w("metar") + "select concat('R', id) as raw_text, station_id from metar where id % 23 <> 5 and id % 17 <> 3",
    "metar_quarantine": w("metar") + "select id, true as has_file from metar where id % 23 = 5 or id % 17 = 3",
    "json_quarantine": "select event_id, event_id % 19 = 4 as broken from events",
    "sql_boards": f"""with {BOARD} select o_orderkey as k, 0 as place, concat('08:', lpad(cast(o_orderkey % 60 as varchar), 2, '0'),
  case when delayed then '09:05 [01-16]' else '' end, 'G', o_orderkey % 9) as departure, 'On time' as status from page""",
    "sql_similarity": f"""with g as (select p_partkey, {grams('p_name')} as a, {grams("concat(p_type, ' ', substr(p_name, 1, 5))")} as b from part)
select p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) as score from g""",
    "sql_weather": f"""select a.id, a.wx, a.words, s.severity from ({NORMALIZE['wx_decode']}) a join ({NORMALIZE['wx_severity']}) s on s.id = a.id""",
}
