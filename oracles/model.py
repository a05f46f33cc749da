"""DuckDB statements for features and score evaluation."""

from .associate import REF, WIDE
from .normalize import ZONE
from .prelude import with_tables as w

SCORED = """scored as (select cast(l_returnflag = 'R' as int) as label, floor(l_extendedprice / 11) / 10000 as score, l_linenumber
  from lineitem)"""
CURVE = """g as (select score, cast(sum(label) as bigint) as pos, cast(sum(1 - label) as bigint) as neg from scored group by 1),
c as (select *, cast(sum(pos) over (order by score desc) as bigint) as tp, cast(sum(neg) over (order by score desc) as bigint) as fp,
  cast(sum(pos) over () as bigint) as p, cast(sum(neg) over () as bigint) as n from g)"""
W = f"with {SCORED}, {CURVE} "
AUC = "cast(sum(neg * (2 * tp - pos)) as double) / (2.0 * max(p) * max(n))"
AP = "sum(pos * (tp / (tp + fp))) / max(p)"
BEST = """(select {'t': score, 'f': 2 * tp / (tp + fp + p)} from c order by 2 * tp / (tp + fp + p) desc, score limit 1)"""


def half(name, condition):
    """Metrics of one part of the scores at threshold 0.4."""
    return f"""{name}_s as (select * from scored where {condition}),
{name}_g as (select score, sum(label) as pos, sum(1 - label) as neg from {name}_s group by 1),
{name}_c as (select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
  sum(pos) over () as p, sum(neg) over () as n from {name}_g),
{name}_k as (select cast(count(case when score >= 0.4 and label = 1 then 1 end) as double) as tp,
  count(case when score >= 0.4 and label = 0 then 1 end) as fp, count(case when score < 0.4 and label = 1 then 1 end) as fn from {name}_s),
{name} as (select (select cast(sum(neg * (2 * tp - pos)) as double) / (2.0 * max(p) * max(n)) from {name}_c) as roc_auc,
  (select sum(pos * (cast(tp as double) / (tp + fp))) / max(p) from {name}_c) as pr_auc, 2 * tp / (2 * tp + fp + fn) as f1_score,
  tp / (tp + fp) as precision, tp / (tp + fn) as recall from {name}_k)"""


NAMES = ["roc_auc", "pr_auc", "f1_score", "precision", "recall"]
GAPS = ", ".join(
    f"round(a.{c}, 9) as train_{c}, round(b.{c}, 9) as test_{c}, round(a.{c} - b.{c}, 9) as {c}_gap, "
    f"round((a.{c} - b.{c}) / a.{c} * 100, 9) as {c}_gap_percent" for c in NAMES
)
MEAN = "(" + " + ".join(f"abs((a.{c} - b.{c}) / a.{c} * 100)" for c in NAMES) + ") / 5"

LOCAL = f"""z as (select concat('AP', lpad(cast(n_nationkey as varchar), 2, '0')) as code, {ZONE} as off from nation n),
l as (select f.row_key, f.departure_scheduled_utc as du, f.arrival_scheduled_utc as au,
  f.departure_scheduled_utc + interval '1' minute * d.off as dl, f.arrival_scheduled_utc + interval '1' minute * a.off as al
  from flight f join z d on f.from_airport = d.code join z a on f.to_airport = a.code)"""


def has(column, *codes):
    return "(" + " or ".join(f"contains(coalesce({column}, ''), '{c}')" for c in codes) + ")"


FRAME = w("flight", "metar", "taf", "sky_condition", extra=REF + f""",
view as ({WIDE.replace('f.delay_min, f.status', 'f.delay_min, f.departure_actual_utc, t.wind_gust_kt as t_wind_gust_kt, f.status')}),
hours as (select distinct date_trunc('hour', departure_scheduled_utc) as h from view where status_final is not null),
kept as (select * from view where date_trunc('hour', departure_scheduled_utc) in (select h from hours)),
cut as (select * from kept where departure_scheduled_utc < (select max(departure_scheduled_utc) - interval '24' hour from kept)),
shares as (select from_airport, round(count(*) / (select count(*) from cut), 9) as share from cut group by 1),
z as (select concat('AP', lpad(cast(n_nationkey as varchar), 2, '0')) as code, {ZONE} as off from nation n)""")

SQL = {
    "gap_removal": w("flight", extra="""gappy as (select row_key, departure_scheduled_utc,
  case when (day(departure_scheduled_utc) * 24 + hour(departure_scheduled_utc)) % 5 < 2
    then ([' ', 'NULL', null])[1 + abs(coalesce(delay_min, 0)) % 3] else status_final end as s from flight),
hours as (select distinct date_trunc('hour', departure_scheduled_utc) as h from gappy
  where s is not null and trim(s) <> '' and lower(s) <> 'null')""") + """
select row_key, departure_scheduled_utc from gappy where date_trunc('hour', departure_scheduled_utc) in (select h from hours)""",
    "settled_flights": w("flight") + """
select row_key from flight where departure_scheduled_utc < (select max(departure_scheduled_utc) - interval '24' hour from flight)""",
    "frequency": w("flight") + """
select from_airport, count(*) / (select count(*) from flight where delay_min is null or delay_min <> 0) as share
from flight where delay_min is null or delay_min <> 0 group by 1""",
    "visibility_class": w("metar") + """
select id, case when visibility_statute_mi is null then null when visibility_statute_mi < 5
  then concat('<', cast(floor(visibility_statute_mi) as int) + 1) else '>=5' end as visibility from metar""",
    "severity": w("metar") + """
select id, cast(wind_speed_kt > 20 as int) + cast(coalesce(wind_gust_kt, 0) > 30 as int)
  + cast(coalesce(visibility_statute_mi < 2, false) as int) as severity from metar""",
    "local_time_parts": w("flight", extra=LOCAL) + """
select row_key, cast(hour(dl) as int) as departure_hour_local, cast(hour(al) as int) as arrival_hour_local,
  cast(isodow(dl) - 1 as int) as departure_dayofweek, cast(isodow(al) - 1 as int) as arrival_dayofweek,
  cast(month(dl) as int) as departure_month, cast(quarter(dl) as int) as departure_quarter, cast(day(dl) as int) as departure_day,
  round_even((epoch_us(au) - epoch_us(du)) / 3600000000.0, 1) as flight_duration_hours,
  cast(hour(dl) in (7, 8, 17, 18, 19) as int) as is_rush_hour_dep, cast(hour(al) in (7, 8, 17, 18, 19) as int) as is_rush_hour_arr,
  cast(isodow(dl) >= 6 as int) as is_weekend, cast(day(dl) > 25 as int) as is_month_end, cast(day(dl) <= 5 as int) as is_month_start
from l""",
    "target_flag": w("flight") + "select row_key, cast(coalesce(delay_min, 0) > 15 as int) as delay from flight",
    "class_shares": w("flight") + """
select cast(coalesce(delay_min, 0) > 15 as int) as delay, count(*) as rows, count(*) / (select count(*) from flight) as share
from flight group by 1""",
    "feature_frame": FRAME + f"""
select f.from_airport, count(*) as n, count(case when delay_min > 15 then 1 end) as late,
  cast(sum(cast(coalesce(wind_speed_kt, 0) > 20 as int) + cast(coalesce(wind_gust_kt, 0) > 30 as int)
    + cast(coalesce(visibility_statute_mi < 2, false) as int)) as bigint) as dep,
  cast(sum(cast(coalesce(t_wind_speed_kt, 0) > 20 as int) + cast(coalesce(t_wind_gust_kt, 0) > 30 as int)
    + cast(coalesce(t_visibility_statute_mi < 2, false) as int)) as bigint) as arr,
  count(case when {has('wx_string', 'TS', 'FG')} then 1 end) as high,
  cast(sum((epoch_us(arrival_scheduled_utc) - epoch_us(departure_scheduled_utc)) // 60000000) as bigint) as minutes,
  cast(sum((epoch_us(departure_actual_utc) - epoch_us(departure_scheduled_utc)) // 60000000) as bigint) as shift,
  max(s.share) as share,
  count(case when hour(arrival_scheduled_utc + interval '1' minute * z.off) in (7, 8, 17, 18, 19) then 1 end) as rush
from cut f join shares s on f.from_airport = s.from_airport join z on f.to_airport = z.code
where status <> 'CANCELLED' group by 1""",
    "sample_rows": w("flight") + """
select row_key, airline_code from flight order by ('0x' || substr(md5(concat('42|', row_key)), 1, 15))::bigint, row_key limit 1000""",
    "pr_points": W + """select score as threshold, tp / (tp + fp) as precision, tp / p as recall, tp / p as tpr, fp / n as fpr from c""",
    "roc_auc": W + f"select {AUC} as roc_auc from c",
    "avg_precision": W + f"select round({AP}, 9) as pr_auc from c",
    "best_threshold": W + f"select b.t as threshold, b.f as f1 from (select {BEST} as b)",
    "risk_bands": W + f"select (select median(score) from scored where label = 0) as risk_threshold_low, {BEST}.t as risk_threshold_high",
    "score_metrics": W + f""", b as (select {BEST}.t as t),
k as (select count(case when score < t and label = 0 then 1 end) as tn, count(case when score >= t and label = 0 then 1 end) as fp,
  count(case when score < t and label = 1 then 1 end) as fn, count(case when score >= t and label = 1 then 1 end) as tp from scored, b)
select (select {AUC} from c) as roc_auc, (select round({AP}, 9) from c) as pr_auc, 2 * tp / (2 * tp + fp + fn) as f1_score,
  tp / (tp + fp) as precision, tp / (tp + fn) as recall, t as optimal_threshold, tn, fp, fn, tp, tn + fp + fn + tp as n_samples,
  tp + fn as positives, tn + fp as negatives from k, b""",
    "overfit_gaps": f"with {SCORED}, {half('a', 'l_linenumber > 1')}, {half('b', 'l_linenumber = 1')} "
    + f"""select {GAPS}, round({MEAN}, 9) as average_gap_percent, case when {MEAN} < 5 then 'Excellent' when {MEAN} < 10 then 'Bon'
  when {MEAN} < 20 then 'Moyen' else 'Problématique' end as overfitting_status from a, b""",
    "calibration": f"""with {SCORED} select cast(greatest(ceil(score * 10) - 1, 0) as int) as bin, count(*) as n,
  round(avg(score), 9) as mean_score, round(avg(label), 9) as positive_rate from scored group by 1""",
    "brier": f"with {SCORED} select round(avg((score - label) * (score - label)), 9) as brier_score from scored",
    "score_histogram": f"""with {SCORED}, b as (select label, min(score) as lo, max(score) as hi from scored group by 1)
select label, cast(least(floor((score - lo) / ((hi - lo) / 30)), 29) as bigint) as bin, count(*) as n
from scored join b using (label) group by 1, 2""",
    "prediction_summary": f"""with {SCORED}, s as (select count(*) as flights, count(case when score >= 0.5 then 1 end) as late,
  count(case when score < 0.5 then 1 end) as on_time, count(case when score < 0.3 then 1 end) as low,
  count(case when score >= 0.3 and score < 0.6 then 1 end) as medium, count(case when score >= 0.6 then 1 end) as high,
  round(avg(score), 9) as mean_probability, min(score) as min_probability, max(score) as max_probability,
  median(score) as median_probability from scored)
select *, """ + ", ".join(f"round({c} * 100.0 / flights, 9) as {c}_pct" for c in ("late", "on_time", "low", "medium", "high")) + " from s",
}
