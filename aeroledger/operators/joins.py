"""Joins that keep rows without a key out of each other's way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_spread(
    left: DataFrame, right: DataFrame, key: str, spread_by: Column, more: tuple[str, ...] = ()
) -> DataFrame:
    """Left join on ``key`` (and ``more``) where rows without a key are dealt out by ``spread_by``.

    A plain left join sends all of them to one task, as they share the null key. Here
    they carry a hash in its place and a mark that no row of ``right`` has. The key keeps
    its type, a long or a string.
    """
    kind = dict(left.dtypes)[key]
    missing = F.col(key).isNull()
    # So many places deal rows out to any number of tasks, and a short place shuffles less than a whole hash.
    place = F.pmod(F.xxhash64(spread_by), F.lit(1 << 20)).cast(kind)
    marked = left.withColumns({"_key": F.coalesce(F.col(key), place), "_known": ~missing})
    known = right.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_key").withColumn("_known", F.lit(True))
    return marked.join(known, ["_key", "_known", *more], "left").drop("_key", "_known")
