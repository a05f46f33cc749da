"""Gapless places in ordered groups, without a group ever being one task's work.

Rows of equal group and order columns are interchangeable, so they travel as one row with a number of
``copies``. The rows are cut into ranges of (group, order); a range counts its rows per group, the counts are
cumulated over the ranges, and within a range a window cumulates the rest. A group with a third of all rows
spans a third of the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

# Places that one row is expanded to at once.
CHUNK = 4096


def ranked(rows: DataFrame, groups: list[str], order: list[str], copies: str = "copies") -> DataFrame:
    """``rows`` with ``first``: how many rows of its group come before each.

    (groups, order) must be distinct and the group columns not null; nulls in the order come first.
    """
    # The ranges are written: their bounds are sampled, so a second run might choose others.
    cut = reliable_checkpoint(rows.repartitionByRange(*groups, *order).withColumn("range_part", F.spark_partition_id()))
    counts = cut.groupBy(*groups, "range_part").agg(F.sum(copies).alias("in_part"))
    earlier = W.partitionBy(*groups).orderBy("range_part").rowsBetween(W.unboundedPreceding, -1)
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("in_part").over(earlier), F.lit(0))).drop("in_part")
    before = W.partitionBy(*groups, "range_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = cut.withColumn("inside", F.coalesce(F.sum(copies).over(before), F.lit(0)))
    joined = placed.join(ahead, [*groups, "range_part"])
    return joined.withColumn("first", F.col("ahead") + F.col("inside")).drop("ahead", "inside", "range_part")


def _steps(first: Column, count: Column, step: int) -> Column:
    return F.sequence(first, first + count - 1, F.lit(step).cast("long"))


def expanded(rows: DataFrame, name: str, first: str = "first", copies: str = "copies", chunk: int = CHUNK) -> DataFrame:
    """A row per copy, with its place ``name``; rows with very many copies are dealt out in chunks first."""
    start, count = F.col(first), F.col(copies).cast("long")
    few = rows.where(count <= chunk).withColumn(name, F.explode(_steps(start, count, 1)))
    chunks = rows.where(count > chunk).withColumn("chunk_at", F.explode(_steps(start, count, chunk)))
    left = F.least(F.lit(chunk).cast("long"), start + count - F.col("chunk_at"))
    many = chunks.repartition("chunk_at").withColumn(name, F.explode(_steps(F.col("chunk_at"), left, 1)))
    return few.unionByName(many.drop("chunk_at")).drop(first, copies)
