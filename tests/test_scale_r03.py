"""What the findings of round 3 asked for: work that is done once, and parsing that reads plain markup alike."""

from __future__ import annotations

import datetime as dt

import pytest
from html.parser import HTMLParser
from pyspark.sql import functions as F

from aeroledger import catalog_io
from aeroledger.operators import associate, lsh, merge, neighbours
from aeroledger.sources import boards
from aeroledger.streaming import jobs


class Whole(boards._Page):
    def _plain(self, html):
        return 0


def elements(page):
    return page.tags, page.attrs, page.starts, page.ends, page.subs, page.text


@pytest.mark.parametrize("html", [
    '<TD CLASS="a&amp;b" href="x>y">a &lt; b</td>c', "<p><p>x</div></p>y", '<br/><img src="x" />t', "<!-- a -- b --><b>x</b>",
    "<script>if (a<b) '</p>'</script><i>z", "<a href=x b>y</a>", '<!doctype html><table class="t"\n><tr>', "a & b", "<![CDATA[x]]><p>", "x<",
])
def test_plain_tokens_are_read_as_the_parser_reads_them(html):
    assert elements(boards._Page(html)) == elements(Whole(html))


def test_plain_pages_do_not_reach_the_parser(monkeypatch):
    fed = []
    monkeypatch.setattr(HTMLParser, "feed", lambda self, data: fed.append(data))
    page = boards._Page('<!-- c --><table class="x"><tr><td>1</td></tr></table>')
    assert page.tags == ["table", "tr", "td"] and page.text == "1" and not fed


@pytest.mark.parametrize("search", [neighbours.nearest, lsh.approximate])
def test_equal_query_vectors_are_asked_once(spark, monkeypatch, search):
    base = neighbours.distinct_vectors(spark.createDataFrame([([float(i)], i % 2) for i in range(9)], "vector array<double>, label int"))
    queries = spark.createDataFrame([(n, [float(n % 2)]) for n in range(40)], "qid long, vector array<double>")
    asked, whole = [], neighbours._nearest

    def counted(rows, *more, **named):
        asked.append(rows.count())
        return whole(rows, *more, **named)

    monkeypatch.setattr(neighbours, "_nearest", counted)
    monkeypatch.setattr(lsh, "_nearest", counted)
    found = search(queries, base, 2)
    assert found.count() == 80 and asked == [2]
    assert found.filter("distance = 0").count() == 40


def test_new_rows_are_written_as_columns(spark):
    target = spark.createDataFrame([(1, "a")], "id long, t string")
    source = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d"), (None, "e")], "id long, t string")
    fresh = merge.new_rows(target, source, ["id"], ["t"])
    assert sorted(fresh.collect(), key=str) == [(2, "c"), (None, "e")]
    assert fresh.inputFiles() and all(name.endswith(".parquet") for name in fresh.inputFiles())


def test_distinct_forecasts_are_made_by_the_first_batch_only(spark, monkeypatch):
    made, whole = [], associate.distinct_forecasts
    monkeypatch.setattr(associate, "distinct_forecasts", lambda taf: made.append(1) or whole(taf))
    noon = dt.datetime(2024, 1, 1, 12)
    taf = spark.createDataFrame(
        [(5, "LFPG", noon, None, "FM")],
        "id long, station_id string, fcst_time_from timestamp_ntz, fcst_time_to timestamp_ntz, change_indicator string",
    )
    airports = spark.createDataFrame([("CDG", "LFPG")], "iata_code string, icao_code string")
    table = spark.createDataFrame([], "flight_key string, taf_id long")
    step = jobs.link_step(taf, airports, ["flight_key"], ["arrival_scheduled_utc"])
    for key in ("f1", "f2"):
        batch = spark.createDataFrame(
            [(key, "CDG", None, noon)], "flight_key string, to_airport string, operated_by string, arrival_scheduled_utc timestamp_ntz"
        )
        table = step(table, batch)
    assert sorted(map(tuple, table.collect())) == [("f1", 5), ("f2", 5)] and made == [1]


def test_landed_slices_have_as_many_files_as_their_table_has_splits(spark, tmp_path):
    spark.range(40_000).repartition(9).selectExpr("id", "repeat(cast(id as string), 20) as t").write.parquet(f"{tmp_path}/rows.parquet")
    base, _, files = catalog_io._files_of(spark, str(tmp_path), "rows", ["id % 2 = 0", "id % 3 = 0"], "slices")
    assert files == spark.read.parquet(f"{tmp_path}/rows.parquet").rdd.getNumPartitions() > catalog_io.SLICE_FILES
    assert len(spark.read.parquet(base).inputFiles()) == 2 * files
