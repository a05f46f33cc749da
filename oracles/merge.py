"""DuckDB statements for merges, dimensions and data quality."""

from .prelude import with_tables as w

OFFERS = """offers as (select id, batch, station_id, concat_ws('/', wx_string, batch) as wx_string
  from metar, range(1, 3) r(b0), lateral (select cast(b0 as int) as batch) where batch <= 1 + id % 2),
stored as (select id, 0 as batch, station_id, 'kept' as wx_string from offers where batch = 1 and id % 3 = 0),
added as (select * from offers o where batch = 1 and id not in (select id from stored))"""

KEY = "flight_number, from_airport, to_airport, departure_scheduled_utc"

CARRIER = """carrier as (select c_custkey as id, concat(lower(c_mktsegment), ' air ', c_custkey % 13) as name,
  case when c_custkey % 11 = 0 then null else concat(chr(cast(65 + c_custkey % 23 as int)), (c_custkey * 7) % 10) end as iata,
  case when c_custkey % 4 = 0 then null else lpad(cast(c_custkey % 389 as varchar), 3, 'I') end as icao,
  concat('NATION_', c_nationkey) as country_name,
  case c_custkey % 3 when 0 then 'N' when 1 then 'Y' else 'y' end as active from customer),
brand as (select concat('Machinery AIR ', s_suppkey % 13) as brand, cast(min(s_suppkey) as double) as average_age
  from supplier group by 1),
authority as (select concat(chr(cast(65 + s_suppkey % 23 as int)), (s_suppkey * 7) % 10) as iata,
  lpad(cast((s_suppkey * 3) % 389 as varchar), 3, 'i') as icao, concat('Machinery Air ', s_suppkey % 13) as name from supplier)"""

AIRLINE_DIM = """airline_dim as (select c.id, c.name, c.iata, c.icao, concat('N', n.n_nationkey) as country_code,
  b.average_age, case when upper(c.active) = 'Y' then 'Y' else 'N' end as active
  from carrier c left join nation n on c.country_name = n.n_name left join brand b on upper(b.brand) = upper(c.name)
  where length(c.iata) = 2 or length(c.icao) = 3)"""

AIRPORT_DIM = r"""own as (select p_partkey as id, concat('ID', p_partkey) as ident, lower(p_type) as airport_type,
  p_name as airport_name, p_retailprice as latitude_deg, -p_retailprice as longitude_deg, p_brand as iso_country,
  'EU' as continent, p_type as iso_region,
  case when p_partkey % 3 = 0 then null else concat('IC', p_partkey) end as icao_code,
  case when p_partkey % 4 < 2 then null else concat('IA', p_partkey) end as iata_code from part),
other as (select coalesce(case when c_custkey % 3 = 0 then null else concat('IA', c_custkey) end, concat('IC', c_custkey)) as k,
  case when c_custkey % 7 <> 0 then c_name end as city,
  case when c_custkey % 5 = 0 then null else 'Europe/Paris' end as timezone,
  case when c_custkey % 2 = 0 then null else '1' end as gmt_offset from customer),
airport_dim as (select own.*, cast(null as varchar) as gps_code, cast(null as varchar) as local_code,
  coalesce(other.city, own.airport_name) as city, other.timezone, other.gmt_offset
  from own left join other on coalesce(own.iata_code, own.icao_code) = other.k
  where own.icao_code is not null or own.iata_code is not null)"""

ROUTES = """route as (select case when delay_min = 7 then null else airline_code end as airline_iata,
  from_airport as source_airport_iata,
  case when delay_min = 8 then null when delay_min = 9 then 'AP99' else to_airport end as dest_airport_iata,
  case when status = 'LANDED' then null else 'Y' end as shared, 0 as stops, flight_number as equipments from flight)"""


def grams(column):
    words = f"list_filter(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    return (f"list_distinct(flatten(list_transform({words}, lambda x: list_transform(range(1, length(x) + 2), "
            f"lambda i: substr('  ' || x || ' ', i, 3)))))")


COUNTRY = f"""country as (select min(p_partkey) as id, concat('C', min(p_partkey)) as code, concat(p_name, ' ', p_brand) as name
  from part group by 3),
fleet as (select concat(upper(p_name), '-', p_type) as country_name, cast(max(p_partkey) as double) as average_age from part group by 1),
cg as (select *, {grams('name')} as g from country), fg as (select *, {grams('country_name')} as g from fleet),
pairs as (select id, code, name, country_name, average_age, len(list_intersect(cg.g, fg.g)) as i,
  len(cg.g) + len(fg.g) as s from cg, fg),
scored as (select id, code, name, country_name, average_age, i / (s - i) as score from pairs where i / (s - i) > 0.3),
ranked as (select *, row_number() over (partition by country_name order by score desc, code) as a,
  row_number() over (partition by code order by score desc, country_name) as b from scored),
matched as (select id, code, country_name, average_age, score from ranked where a = 1 and b = 1)"""


def authority(source, name):
    """Chosen airline per code among ``source``: exact matches first, else the nearest name."""
    return f"""{name}_exact as (select c.iata, min(c.id) as id from {source} c join authority a on c.iata = a.iata
  and (upper(c.icao) = upper(a.icao) or lower(c.name) = lower(a.name)) group by 1),
{name}_near as (select c.iata, arg_min(c.id, {{'w': levenshtein(lower(c.name), lower(a.name)) / greatest(length(c.name), length(a.name)) - 1,
  'id': c.id}}) as id from {source} c join (select distinct iata, name from authority) a on c.iata = a.iata
  where c.iata not in (select iata from {name}_exact) group by 1),
{name} as (select iata, id, 'exact' as rule from {name}_exact union all select iata, id, 'nearest' from {name}_near)"""


def violations(parts):
    return " union all ".join(f"select '{n}' as \"check\", (select count(*) from {q}) as violations" for n, q in parts)


def fk(table, column, parent):
    return f"{table} where {column} is not null and {column} not in (select id from {parent})"


def dup(table, cols):
    first = " and ".join(f"{c} is not null" for c in cols.split(", "))
    return f"(select 1 from {table} where {first} group by {cols} having count(*) > 1)"


SQL = {
    "insert_ignore": w("metar", extra=OFFERS) + "select * from stored union all select * from added",
    "insert_counts": w("metar", extra=OFFERS) + """
select o.batch, count(*) as offered, count(a.id) as inserted, count(*) - count(a.id) as duplicates
from offers o left join added a on o.id = a.id and o.batch = a.batch group by 1""",
    "insert_with_children": w("metar", "sky_condition", extra=OFFERS) + """
select s.id, s.metar_fk, s.sky_cover, s.condition_order from sky_condition s
where s.metar_fk in (select id from added)""",
    "upsert_counters": """
with t as (select cast(o_orderkey * 2 as varchar) as doc_id, o_orderstatus as status, o_orderkey % 3 > 0 as is_updated,
  o_orderkey % 3 as update_count, case when o_orderkey % 4 = 0 then concat('M', o_orderkey) end as metar_id from orders),
s as (select cast(l_orderkey as varchar) as doc_id, count(*) as k,
  arg_max(l_returnflag, {'a': l_linenumber, 'b': l_partkey, 'c': l_suppkey, 'd': l_returnflag}) as status
  from lineitem group by 1)
select coalesce(t.doc_id, s.doc_id) as doc_id, coalesce(s.status, t.status) as status,
  case when s.k is null then 's1' else 's2' end as collection_session_id,
  case when s.k is null then t.is_updated else t.doc_id is not null or s.k > 1 end as is_updated,
  case when s.k is null then t.update_count when t.doc_id is not null then t.update_count + s.k else s.k - 1 end as update_count,
  case when s.k is not null and (t.doc_id is not null or s.k > 1) then timestamp '2024-02-01' end as last_updated_at,
  case when s.k > 1 then 's2' when s.k = 1 and t.doc_id is not null then 's1' end as previous_collection_session_id,
  t.metar_id
from t full outer join s on t.doc_id = s.doc_id""",
    "late_actuals": w("flight", extra=f"""late as (select {KEY},
  arg_max({{'f': departure_actual_utc, 'a': arrival_scheduled_utc + interval '1' minute * (delay_min + 2), 'd': delay_min + 2}},
    row_key) as v
  from flight where status = 'LANDED' group by {KEY})""") + f"""
select f.row_key, case when l.v is not null then l.v.f end as departure_final_utc,
  case when l.v is not null then l.v.a else f.arrival_actual_utc end as arrival_actual_utc,
  case when l.v is not null then 'FINAL2' else f.status_final end as status_final,
  case when l.v is not null then l.v.d else f.delay_min end as delay_min
from flight f left join late l using ({KEY})""",
    "prediction_writeback": w("flight") + """
select row_key, case when delay_min <> 0 then abs(delay_min) / 50.0::double else delay_prob end as delay_prob,
  case when delay_min <> 0 then case when delay_min > 20 then 'high' when delay_min > 5 then 'medium' end
    else delay_risk_level end as delay_risk_level
from flight""",
    "incremental_dim": """
select p_partkey as id, p_name as name, p_size as size from part where p_partkey % 5 <> 0 and p_partkey % 3 <> 0
union all select p_partkey, upper(p_name), p_size + 100 from part where p_partkey % 3 = 0""",
    "upsert_latest": """
with s as (select o_custkey as id, arg_max(o_orderpriority, o_orderkey) as segment, arg_max(o_totalprice, o_orderkey) as amount
  from orders where o_custkey % 2 = 0 group by 1)
select * from s union all select c_custkey, c_mktsegment, c_acctbal from customer where c_custkey not in (select id from s)""",
    "set_links": w("flight") + """
select row_key, case when arrival_taf_fk % 3 = 0 then concat('M', departure_metar_fk)
  when departure_metar_fk % 2 = 0 then 'old' end as metar_id from flight""",
    "cascade_delete": w("metar", "sky_condition") + """
select id, metar_fk, taf_fk, sky_cover from sky_condition
where metar_fk is null or metar_fk in (select id from metar where wx_string is not null)""",
    "airline_dim": "with " + CARRIER + "," + AIRLINE_DIM + " select * from airline_dim",
    "active_flag": "with " + CARRIER + """,
prev as (select id, case id % 4 when 0 then 'Y' when 1 then 'N' when 2 then 'Y' end as stored from carrier where id % 5 <> 0)
select c.id, c.name, case when p.id is null then case when upper(c.active) = 'Y' then 'Y' else 'N' end
  when stored = 'Y' and upper(c.active) = 'N' then 'N' when stored = 'N' and upper(c.active) = 'Y' then 'Y'
  else stored end as active
from carrier c left join prev p on c.id = p.id""",
    "active_dups": "with " + CARRIER + """
select iata, count(case when upper(active) = 'Y' then 1 end) as active_rows from carrier where iata is not null
group by 1 having active_rows > 1""",
    "authority_exact": "with " + CARRIER + """
select c.iata, min(c.id) as id from carrier c join authority a on c.iata = a.iata
  and (upper(c.icao) = upper(a.icao) or lower(c.name) = lower(a.name)) group by 1""",
    "authority_match": "with " + CARRIER + ", " + authority("carrier", "chosen") + " select * from chosen",
    "clear_active_dups": "with " + CARRIER + """,
repeated as (select iata from carrier where upper(active) = 'Y' and iata is not null group by 1 having count(*) > 1),
contested as (select * from carrier where upper(active) = 'Y' and iata in (select iata from repeated)), """ + authority("contested", "chosen") + """
select c.* replace (case when upper(c.active) = 'Y' and c.iata in (select iata from repeated)
  and not coalesce(c.id = (select id from chosen k where k.iata = c.iata), false) then 'N' else c.active end as active) from carrier c""",
    "one_row_per_iata": "with " + CARRIER + """,
many as (select * from carrier where iata in (select iata from carrier group by 1 having count(*) > 1)), """ + authority("many", "chosen") + """
select c.* from carrier c join (select s.iata, coalesce(k.id, s.id) as id from
  (select iata, min(id) as id from carrier where iata is not null group by 1) s left join chosen k using (iata)) w
  on c.iata = w.iata and c.id = w.id""",
    "airport_dim": "with " + AIRPORT_DIM + " select * from airport_dim",
    "distinct_airports": "with " + AIRPORT_DIM
        + " select distinct id, iata_code from airport_dim where iata_code is not null",
    "route_dim": w("flight", "airline", "airport", extra=ROUTES) + """
select r.airline_iata, cast(substr(a.iata, 2) as bigint) as airline_id, r.source_airport_iata,
  cast(s.id as bigint) as source_airport_id, r.dest_airport_iata, cast(d.id as bigint) as dest_airport_id,
  r.shared, r.stops, r.equipments
from route r join airline a on r.airline_iata = a.iata join airport s on r.source_airport_iata = s.iata_code
join airport d on r.dest_airport_iata = d.iata_code""",
    "runway_semi": """select o_orderkey as id, cast(o_custkey % 40 as int) as airport_ref, o_orderpriority as surface
from orders where o_custkey % 40 in (select n_nationkey from nation)""",
    "country_fuzzy": "with " + COUNTRY + " select name, country_name, score from scored",
    "country_match": "with " + COUNTRY + " select * from matched",
    "union_countries": "with " + COUNTRY + """
select * from matched union all select id, code, name, null, null from country where id not in (select id from matched)""",
    "country_anti": "with " + COUNTRY + " select * from country where id not in (select id from matched)",
    "first_seen_dedup": w("flight") + """
select airline_code as carrier, flight_number, cast(departure_scheduled_utc as date) as dep_date,
  strftime(departure_scheduled_utc, '%H:%M') as dep_time, min(row_key) as row_key from flight group by 1, 2, 3, 4""",
    "snapshot_delta": """
with o as (select l_orderkey, l_linenumber, l_quantity, l_returnflag, count(*) as n from lineitem group by all),
w as (select l_orderkey, l_linenumber, l_quantity, case when l_quantity > 45 then 'X' else l_returnflag end as l_returnflag,
  count(*) as n from lineitem group by all)
select coalesce(w.l_orderkey, o.l_orderkey) as l_orderkey, coalesce(w.l_linenumber, o.l_linenumber) as l_linenumber,
  coalesce(w.l_quantity, o.l_quantity) as l_quantity, coalesce(w.l_returnflag, o.l_returnflag) as l_returnflag,
  case when coalesce(w.n, 0) > coalesce(o.n, 0) then 'added' else 'removed' end as change,
  abs(coalesce(w.n, 0) - coalesce(o.n, 0)) as copies
from w full outer join o using (l_orderkey, l_linenumber, l_quantity, l_returnflag)
where coalesce(w.n, 0) <> coalesce(o.n, 0)""",
    "snapshot_changed": """
with r as (select copy, ('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
    cast(l_quantity as bigint), case when copy = 'new' and l_quantity > 45 then 'X' else l_returnflag end)), 1, 15))::bigint as h
  from lineitem, (values ('old'), ('new')) c(copy))
select copy, count(*) as rows, bit_xor(h) as digest, cast(sum(h % 1000003) as bigint) as sum from r group by copy""",
    "dq_unique": """select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1""",
    "dq_relationship": w("flight", "metar") + """
select row_key, departure_metar_fk from flight where departure_metar_fk not in (select id from metar)""",
    "dq_accepted": "with " + CARRIER + " select id, active from carrier where active not in ('Y', 'N')",
    "dq_one_parent": w("sky_condition", extra="""broken as (select id, metar_fk,
  case when id % 7 = 0 then metar_fk else taf_fk end as taf_fk from sky_condition)""") + """
select id from broken where (metar_fk is null) = (taf_fk is null)""",
    "dq_not_null": "with " + CARRIER + " select id from carrier where iata is null",
    "dq_report": w("flight", "metar", "taf", "sky_condition") + violations([
        ("flight.departure_metar_fk", fk("flight", "departure_metar_fk", "metar")),
        ("flight.arrival_taf_fk", fk("flight", "arrival_taf_fk", "taf")),
        ("sky.metar_fk", fk("sky_condition", "metar_fk", "metar")),
        ("sky.taf_fk", fk("sky_condition", "taf_fk", "taf")),
        ("sky.one_parent", "sky_condition where (metar_fk is null) = (taf_fk is null)"),
        ("metar.external_id unique", dup("metar", "external_id")),
        ("taf.external_id unique", dup("taf", "external_id")),
    ]),
    "dq_dimensions": w("flight", extra=CARRIER + "," + AIRLINE_DIM + "," + AIRPORT_DIM + "," + ROUTES + """,
runway as (select o_orderkey as id, o_custkey * 2 as airport_ref from orders),
code as (select concat('N', n_nationkey) as id from nation)""") + violations([
        ("countries.code unique", dup("code", "id")),
        ("countries.code not_null", "code where id is null"),
        ("airlines.id unique", dup("airline_dim", "id")),
        ("airlines.id not_null", "airline_dim where id is null"),
        ("airlines.iata unique", dup("airline_dim", "iata")),
        ("airlines.iata not_null", "airline_dim where iata is null"),
        ("airlines.country_code relationship", fk("airline_dim", "country_code", "code")),
        ("airlines.active accepted", "airline_dim where active not in ('Y', 'N')"),
        ("airports.id not_null", "airport_dim where id is null"),
        ("airports.iata_code unique", dup("airport_dim", "iata_code")),
        ("airports.iso_country relationship", fk("airport_dim", "iso_country", "code")),
        ("routes key unique", dup("route", "airline_iata, source_airport_iata, dest_airport_iata")),
        ("runways.id not_null", "runway where id is null"),
        ("runways.airport_ref not_null", "runway where airport_ref is null"),
        ("runways.airport_ref relationship", fk("runway", "airport_ref", "airport_dim")),
        ("routes.airline_iata not_null", "route where airline_iata is null"),
        ("routes.source_airport_iata not_null", "route where source_airport_iata is null"),
        ("routes.dest_airport_iata not_null", "route where dest_airport_iata is null"),
    ]),
}
