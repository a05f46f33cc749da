"""Copies of a file compared through a tree of digests.

A copy is stored by hash bucket of its rows. Each bucket has a digest that does not depend on row order, each group of
buckets one over its buckets' digests, and the copy one over its groups. Two copies are compared from the top: only
groups that differ show their buckets, only buckets that differ are read again, row by row. What has not changed is
not read a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from . import dims

BUCKETS = 4096
FANOUT = 64
BUCKET = "_bucket"


def _row_text(columns: list[str]) -> Column:
    """One text per distinct row: every value with its length, nulls apart from empty texts."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


def _folded(rows: DataFrame, level: int, key: Column) -> DataFrame:
    """One node per key from ``digest`` and ``rows`` below it: sums, so the order does not matter."""
    number = F.conv(F.substring(F.md5("digest"), 1, 15), 16, 10).cast("decimal(38,0)")
    other = F.conv(F.substring(F.md5("digest"), 16, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(key.alias("node")).agg(F.sum("rows").alias("rows"), F.sum(number).alias("a"), F.sum(other).alias("b")).select(
        F.lit(level).alias("level"), "node", F.concat_ws("-", "rows", "a", "b").alias("digest"), "rows"
    )


def store(rows: DataFrame, root: str, buckets: int = BUCKETS, fanout: int = FANOUT) -> None:
    """Write a copy by bucket, and its digest tree: level 2 the buckets, 1 their groups, 0 the whole."""
    spark = rows.sparkSession
    text = _row_text(rows.columns)
    placed = rows.withColumn(BUCKET, F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/rows")
    stored = read(spark, root, rows.schema)
    leaves = _folded(stored.select(F.col(BUCKET), F.md5(text.cast("binary")).alias("digest"), F.lit(1).alias("rows")), 2, F.col(BUCKET))
    leaves.write.mode("overwrite").parquet(f"{root}/tree/2")
    groups = _folded(spark.read.parquet(f"{root}/tree/2"), 1, F.floor(F.col("node") / fanout))
    groups.write.mode("overwrite").parquet(f"{root}/tree/1")
    # At most as many rows as groups.
    _folded(spark.read.parquet(f"{root}/tree/1"), 0, F.lit(0)).write.mode("overwrite").parquet(f"{root}/tree/0")


def read(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())])).parquet(f"{root}/rows")


def changed_nodes(spark: SparkSession, old: str, new: str, level: int, within: list[int] | None = None, fanout: int = FANOUT) -> list[int]:
    """Nodes of a level whose digests differ, or that one copy lacks; at most ``BUCKETS`` numbers."""
    def nodes(root: str, name: str) -> DataFrame:
        rows = spark.read.parquet(f"{root}/tree/{level}").select("node", F.col("digest").alias(name))
        return rows if within is None else rows.where(F.floor(F.col("node") / fanout).isin(within))

    both = nodes(old, "was").join(nodes(new, "is"), "node", "full_outer")
    return sorted(r["node"] for r in both.where(~F.col("was").eqNullSafe(F.col("is"))).collect())


def changed_buckets(spark: SparkSession, old: str, new: str, fanout: int = FANOUT) -> list[int]:
    """Buckets that have to be compared row by row; none if the copies are equal."""
    if not changed_nodes(spark, old, new, 0):
        return []
    groups = changed_nodes(spark, old, new, 1)
    return changed_nodes(spark, old, new, 2, groups, fanout)


def delta(spark: SparkSession, old: str, new: str, schema: StructType, fanout: int = FANOUT) -> DataFrame:
    """Rows added and removed between two stored copies, as ``dims.snapshot_delta`` gives them."""
    buckets = changed_buckets(spark, old, new, fanout)
    sides = [read(spark, root, schema).where(F.col(BUCKET).isin(buckets)).drop(BUCKET) for root in (old, new)]
    return dims.snapshot_delta(*sides)
