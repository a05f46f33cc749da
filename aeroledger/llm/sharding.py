"""Shards by jump consistent hashing, as DataFrame operations only.

A key's digest seeds a linear congruential sequence; every number drawn says at which shard count the key would
jump next, and the last jump below the present count is its shard. There is no ring table: the shard follows from
the key and the count alone, and one more shard takes its even part of the keys and moves no other.

``write_shards`` stores the rows, a folder per shard; ``placement`` numbers the rows of every shard without gaps,
ordered by the digest of (key, size, checksum), which spreads a hot key over the shard. Rows equal in all three are
interchangeable.

Cases: a null key is a key of its own; repeated keys share a shard, as the law says; a null text has no bytes and
the checksum of the empty text; long texts are read once and only their size and checksum are shuffled for the
numbers; an empty table gives empty shards; further columns, whatever their names, are stored and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranks
from .common import free_name, text_bytes

SHARDS = 16

#: Multiplier of the published generator, and the range of the numbers drawn.
MULTIPLIER = 2862933555777941757
DRAWN = float(1 << 31)

LOW32 = 0xFFFFFFFF
# Jumps that are tried for every row; the expected number is about the logarithm of the shard count.
FIRST_JUMPS = 64


def digest_halves(value: Column) -> tuple[Column, Column]:
    """The first 64 bits of the value's MD5 as two numbers of 32 bits; null counts as an empty value."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))


def _state(high: Column, low: Column, shard: Column, jump: Column) -> Column:
    return F.struct(high.alias("high"), low.alias("low"), shard.alias("shard"), jump.alias("jump"))


def _jumped(state: Column, shards: int) -> Column:
    """One step of the sequence; the product modulo 2^64 is put together from 16-bit parts, which cannot overflow."""
    high, low = state["high"], state["low"]
    part0, part1, upper = MULTIPLIER & 0xFFFF, (MULTIPLIER >> 16) & 0xFFFF, MULTIPLIER >> 32

    def shifted(product: Column) -> Column:
        return F.shiftleft(product.bitwiseAND(F.lit(0xFFFF)), 16)

    bottom = low * F.lit(part0) + shifted(low * F.lit(part1)) + F.lit(1)
    top = (
        F.shiftright(bottom, 32) + F.shiftright(low * F.lit(part1), 16) + low * F.lit(upper)
        + high * F.lit(part0) + shifted(high * F.lit(part1))
    ).bitwiseAND(F.lit(LOW32))
    drawn = F.shiftright(top, 1) + 1
    jump = F.floor((state["jump"] + 1) * (F.lit(DRAWN) / drawn)).cast("long")
    return F.when(state["jump"] >= shards, state).otherwise(
        _state(top, bottom.bitwiseAND(F.lit(LOW32)), state["jump"], jump)
    )


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards - 1``, of every key."""
    high, low = digest_halves(key)
    start = _state(high, low, F.lit(-1).cast("long"), F.lit(0).cast("long"))

    def walk(state: Column, first: int, last: int) -> Column:
        return F.aggregate(F.sequence(F.lit(first), F.lit(last)), state, lambda s, _: _jumped(s, shards))

    early = walk(start, 1, min(shards, FIRST_JUMPS))
    if shards <= FIRST_JUMPS:
        return early["shard"].cast("int")
    # Exact for every key: those that are not done, one in many billions, go on.
    rest = F.transform(
        F.array(early), lambda s: F.when(s["jump"] >= shards, s["shard"]).otherwise(walk(s, FIRST_JUMPS + 1, shards)["shard"])
    )
    return rest[0].cast("int")


def write_shards(rows: DataFrame, key: str, folder: str, shards: int = SHARDS) -> tuple[DataFrame, str]:
    """Store all columns of ``rows``, a folder per shard; the stored rows and the name of the shard column.

    A shard that is larger than a task's share is split by the number of its bytes, whatever its keys are.
    """
    name = free_name(rows, "shard")
    marked = rows.withColumn(name, jump_shard(F.col(key), shards)).hint("rebalance", F.col(name))
    marked.write.partitionBy(name).parquet(folder)
    return rows.sparkSession.read.schema(marked.schema).parquet(folder), name


def placement(stored: DataFrame, key: str, shard: str, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every stored row."""
    raw = text_bytes(text)
    seen = stored.select(
        F.col(key), F.col(shard).cast("int").alias("shard"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    groups = seen.groupBy("shard", key, "size", "text_crc32").agg(F.count("*").alias("copies"))
    label = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), "size", "text_crc32")
    high, low = digest_halves(label)
    placed = ranks.ranked(
        groups.withColumn("high", high).withColumn("low", low), ["shard"], ["high", "low", key, "size", "text_crc32"]
    )
    law = placed.withColumn("law", F.lit("key")).withColumn("grown_shard", jump_shard(F.col(key), shards + 1))
    return ranks.expanded(law, "slot").select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
