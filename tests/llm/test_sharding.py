import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aeroledger.llm import ranks, sharding
from aeroledger.session import run_dir

from .helpers import MESSY, messy


def jump(key, shards):
    """The published algorithm, in whole numbers."""
    state = int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)
    shard, step = -1, 0
    while step < shards:
        shard = step
        state = (state * 2862933555777941757 + 1) % 2**64
        step = int((shard + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return shard


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 64, 65, 1000])
def test_shard_of_every_key(spark, shards):
    keys = spark.range(1200).selectExpr("if(id % 50 = 0, null, id * 7919) as k")
    for row in keys.select("k", sharding.jump_shard(F.col("k"), shards).alias("shard")).collect():
        assert row["shard"] == jump(row["k"], shards)


def test_further_jumps_are_exact(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_JUMPS", 2)
    keys = spark.range(500).select("id", sharding.jump_shard(F.col("id"), 40).alias("shard"))
    assert all(r["shard"] == jump(r["id"], 40) for r in keys.collect())


def placed(spark, rows):
    folder = run_dir(spark, "shards")
    stored, name = sharding.write_shards(rows, "doc_id", folder)
    return stored, name, sharding.placement(stored, "doc_id", name).collect()


def test_messy_rows(spark):
    rows = messy(spark).withColumn("shard", F.lit("clash")).withColumn("slot", F.lit(1))
    stored, name, found = placed(spark, rows)
    assert name == "shard_" and stored.count() == len(MESSY)
    assert sorted(map(repr, stored.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    want = sorted(
        (repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump(i, 16), jump(i, 17)) for i, t in MESSY
    )
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in found) == want
    slots = defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row["slot"])
        assert row["law"] == "key" and row["grown_shard"] in (row["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty(spark):
    stored, _, found = placed(spark, messy(spark).limit(0))
    assert stored.count() == 0 and found == []


def test_one_more_shard_takes_its_share(spark):
    keys = spark.range(20_000).select(sharding.jump_shard(F.col("id"), 16).alias("a"), sharding.jump_shard(F.col("id"), 17).alias("b"))
    moved = keys.where("a <> b")
    assert moved.where("b <> 16").count() == 0 and 950 < moved.count() < 1400
    sizes = [r["count"] for r in keys.groupBy("a").count().collect()]
    assert len(sizes) == 16 and min(sizes) > 1100 and max(sizes) < 1400


def test_a_hot_row_is_dealt_out(spark):
    """A third of all rows equal in every column: their slots come from chunks, not from one task."""
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id) as doc_id", "if(id % 3 = 0, 'same', cast(id as string)) as text")
    groups = rows.groupBy("doc_id", "text").agg(F.count("*").alias("copies")).withColumn("one", F.lit(0))
    out = ranks.expanded(ranks.ranked(groups, ["one"], ["doc_id", "text"]), "place", chunk=64)
    places = out.select("doc_id", "place", F.spark_partition_id().alias("part")).collect()
    assert sorted(p["place"] for p in places) == list(range(3000))
    hot = [p for p in places if p["doc_id"] == 5]
    assert len(hot) == 1001 and len({p["part"] for p in hot}) > 1
    assert [p["doc_id"] for p in sorted(places, key=lambda p: p["place"])] == sorted(p["doc_id"] for p in places)
