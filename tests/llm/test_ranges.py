import pytest
from pyspark.sql import functions as F

from aeroledger.llm import common


@pytest.mark.parametrize("ids", [list(range(5000)), [7] * 300, [], [None] * 20, [*range(3000), 10**17, -(10**17)]])
def test_ranges_cover_every_id_in_order(spark, ids):
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(3)
    bounds = common.range_bounds(frame, "doc_id", 100)
    assert bounds == common.range_bounds(frame.repartition(5), "doc_id", 100) == sorted(set(bounds))
    rows = common.by_range(common.with_range(frame, "doc_id", bounds), bounds).withColumn("part", F.spark_partition_id()).collect()
    assert len(rows) == len(ids)
    last = max(1, len(bounds) + 1)
    for row in rows:
        want = last if row["doc_id"] is None else sum(row["doc_id"] >= b for b in bounds)
        assert row["range_no"] == want and row["part"] == want
    if ids[:5] == [0, 1, 2, 3, 4]:
        sizes = frame.count() / (len(bounds) + 1)
        assert 50 < sizes < 200


def test_free_name(spark):
    frame = spark.range(1).withColumn("Key", F.lit(1)).withColumn("key_", F.lit(1))
    assert common.free_name(frame, "key") == "key__" and common.free_name(frame, "other") == "other"


HOT = [*range(200), *[None] * 150, *[77] * 120, *[-5] * 90, 10**17]


def test_null_and_repeated_ids_have_several_ranges(spark):
    data = [(i, f"text {n}") for n, i in enumerate(HOT)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    ranges = common.find_ranges(frame, "doc_id", 40)
    placed = ranges.number(frame, "doc_id", common.hex_place(F.md5("text")))
    rows = common.in_ranges(placed, ranges).withColumn("part", F.spark_partition_id()).withColumn("digest", F.md5("text")).collect()
    assert len(rows) == len(HOT) and all(r["part"] == r["range_no"] < ranges.count for r in rows)
    for hot in (None, 77, -5):
        own = [r["range_no"] for r in rows if r["doc_id"] == hot]
        assert len(set(own)) >= 2 and max(map(own.count, own)) < 70
        # No other id lies in them.
        assert all(r["doc_id"] == hot for r in rows if r["range_no"] in own)
    # The ranges are in the order of (id, digest), null last.
    order = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["digest"]))
    assert [r["range_no"] for r in order] == sorted(r["range_no"] for r in rows)
    falling = ranges.falling()
    assert sorted(falling) == list(range(ranges.count))
    down = sorted(rows, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["digest"]))
    assert [falling.index(r["range_no"]) for r in down] == sorted(falling.index(r["range_no"]) for r in rows)


def test_batches_end_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 1000)

    def run(rows):
        for (n,) in rows:
            yield n, "x" * (n * 10), [0.5] * n, None

    frame = common.map_rows(spark.range(300).repartition(2), run, "n long, text string, numbers array<double>, none binary")
    found = {r["n"]: r for r in frame.collect()}
    assert len(found) == 300 and all(r["text"] == "x" * n * 10 and len(r["numbers"]) == n and r["none"] is None for n, r in found.items())


def test_batch_sizes_are_only_lowered(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    common.prepare(spark)
    assert spark.conf.get(name) == "100"
    spark.conf.set(name, before)
