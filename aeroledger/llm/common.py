"""Helpers that several operators share: row batches, id ranges, published files, components."""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, ship_package

# Rows of one Arrow batch, and characters or bytes of its texts; whole texts travel in it, so it is kept short.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
# Ranges of one written dataset; the bounds are held by the driver and every task.
MAX_RANGES = 16_384
# Sampled ids per range when bounds are chosen.
SAMPLE_PER_RANGE = 32


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the workers and keep batches of whole texts small.

    Batch sizes are settings of the session and are read when a lazy frame runs, so they cannot be put back here; they
    are only ever lowered, and other functions of the session get the same rows in smaller batches.
    """
    ship_package(spark)
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    if int(spark.conf.get(size).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def text_bytes(column: str) -> Column:
    """UTF-8 bytes of a text; a null text is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def decode(raw: bytes) -> str:
    """Text of UTF-8 bytes; bytes that are no UTF-8 become U+FFFD instead of ending the job."""
    return raw.decode("utf-8", "replace")


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(frame: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function(iterator of rows as tuples) -> iterator of tuples`` over Arrow batches.

    A batch of results ends with ``BATCH_ROWS`` rows or ``BATCH_BYTES`` of texts, whichever comes first.
    """
    prepare(frame.sparkSession)
    fields = frame.sparkSession.createDataFrame([], schema).schema
    names = fields.fieldNames()
    sized = [at for at, field in enumerate(fields) if field.dataType.typeName() in ("string", "binary", "array")]
    most = BATCH_BYTES

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(fields)
        held: list[tuple] = []
        size = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(zip(*held), arrow)], names=names)

        for row in function(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))):
            held.append(row)
            for at in sized:
                if row[at] is not None:
                    size += len(row[at])
            if len(held) >= BATCH_ROWS or size >= most:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    return frame.mapInArrow(run, schema)


# ---- id ranges -----------------------------------------------------------------

def range_bounds(frame: DataFrame, column: str, rows_per_range: int, most: int = MAX_RANGES) -> list[int]:
    """Ascending lower bounds of the second and later ranges of an integer id.

    The bounds come from ids whose hash falls into a thin slice, so they depend on
    the ids alone: not on partitions, order or retries. They only lay out files;
    every row belongs to a range. At most 64 sampled ids per range reach the driver.
    """
    ids = frame.select(column).where(F.col(column).isNotNull())
    total = ids.count()
    ranges = min(most, -(-total // rows_per_range))
    if ranges < 2:
        return []
    step = max(1, total // (ranges * SAMPLE_PER_RANGE))
    sample = sorted(
        r[0] for r in ids.where(F.pmod(F.xxhash64(column), F.lit(step)) == 0).distinct().collect()
    )
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)} - {sample[0]}) if sample else []


def with_range(frame: DataFrame, column: str, bounds: list[int], name: str = "range_no") -> DataFrame:
    """The number of the id's range; ids that are null come after all others."""
    splits = sorted({float("-inf"), *map(float, bounds), float("inf")})
    last = len(splits) - 1
    if last < 2:
        return frame.withColumn(name, F.when(F.col(column).isNull(), last).otherwise(0).cast("int"))
    cut = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep")
    number = F.when(F.col(column).isNull(), last).otherwise(F.col(name)).cast("int")
    return cut.transform(frame).withColumn(name, number)


def by_range(frame: DataFrame, bounds: list[int], name: str = "range_no") -> DataFrame:
    """One partition per range."""
    return frame.repartitionById(len(bounds) + 2, F.col(name))


@dataclass(frozen=True)
class Ranges:
    """Ranges of ids in ascending order, null last; an id with very many rows has several, cut by a digest.

    ``parts[n]`` is the number of ranges of the ``n``-th stretch of ids between two ``bounds``; the null ids' stretch is
    the last one.
    """

    bounds: list[int]
    parts: list[int]

    @property
    def count(self) -> int:
        return sum(self.parts)

    def number(self, frame: DataFrame, column: str, place: Column, name: str = "range_no") -> DataFrame:
        """``frame`` with the number of each row's range; ``place`` from 0 to below 1 orders the rows of one id."""
        stretch = free_name(frame, "stretch")
        cut = with_range(frame, column, self.bounds, stretch)
        if self.count == len(self.parts):
            return cut.withColumnRenamed(stretch, name)
        starts = list(accumulate(self.parts, initial=0))
        rows = [(n, starts[n], parts) for n, parts in enumerate(self.parts)]
        first, parts = free_name(frame, "first_range"), free_name(frame, "parts")
        layout = frame.sparkSession.createDataFrame(rows, f"{stretch} int, {first} int, {parts} int")
        # At most three numbers per range.
        joined = cut.join(F.broadcast(layout), stretch)
        return joined.withColumn(name, (F.col(first) + F.floor(place * F.col(parts))).cast("int")).drop(stretch, first, parts)

    def falling(self) -> list[int]:
        """All ranges by falling id, those of one id and of null ids in their own order; null ids last."""
        starts = list(accumulate(self.parts, initial=0))
        order = [*range(len(self.parts) - 2, -1, -1), len(self.parts) - 1]
        return [n for stretch in order for n in range(starts[stretch], starts[stretch + 1])]


def find_ranges(frame: DataFrame, column: str, rows_per_range: int) -> Ranges:
    """Ranges of about ``rows_per_range`` rows; ids with more rows than that get several."""
    bounds = range_bounds(frame, column, rows_per_range)
    # At most as many ids as there are ranges.
    hot = {r[0]: r[1] for r in frame.groupBy(column).count().where(F.col("count") > rows_per_range).collect()}
    alone = {n for n in hot if n is not None and abs(n) < 1 << 52}
    cuts = sorted(set(bounds) | alone | {n + 1 for n in alone})
    sizes = [1] * (len(cuts) + 1)
    for n in alone:
        sizes[bisect_right(cuts, n)] = -(-hot[n] // rows_per_range)
    return Ranges(cuts, [*sizes, max(1, -(-hot.get(None, 0) // rows_per_range))])


def hex_place(digest: Column) -> Column:
    """The leading bits of a digest in hex as a number from 0 to below 1."""
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("double") / float(1 << 28)


def in_ranges(frame: DataFrame, ranges: Ranges, name: str = "range_no") -> DataFrame:
    """One partition per range."""
    return frame.repartitionById(max(1, ranges.count), F.col(name))


# ---- files that appear whole or not at all ---------------------------------------

MANIFEST = "name string, staged string, range_no int, seq int, records long, items long, bytes long, sha256 string"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def staged_name() -> str:
    return f"_temporary/{uuid.uuid4().hex}"


def publish(staged: DataFrame, folder: str) -> DataFrame:
    """Move staged files to their final names and return the manifest.

    ``staged`` has a manifest row per file that a finished task wrote under a name
    of its own attempt. Spark commits those rows once per task, so files of failed
    or repeated attempts have no row and stay unnamed. A move that is repeated
    finds its target and does nothing.
    """
    spark = staged.sparkSession
    staged.write.parquet(f"{folder}/_staged")

    def move(rows: Iterator[tuple]) -> Iterator[tuple]:
        files, root = open_folder(folder)
        for row in rows:
            name, temporary = row[0], row[1]
            source, target = f"{root}/{temporary}", f"{root}/{name}"
            if files.get_file_info(source).type != fs.FileType.NotFound:
                files.move(source, target)
            elif files.get_file_info(target).size != row[6]:
                raise FileNotFoundError(f"{target} is neither staged nor published")
            yield row

    map_rows(spark.read.parquet(f"{folder}/_staged"), move, MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.parquet(f"{folder}/_manifest")


# ---- connected components ----------------------------------------------------------

def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``(node, label)`` with the smallest node that each node of ``(a, b)`` can reach.

    Alternating star contraction: every round hangs each node's larger neighbours,
    then its smaller ones, on its smallest neighbour, until the edges are stars
    around the smallest node. Minima are aggregates and each round's edges lie in
    the shared checkpoint folder.
    """
    both = edges.select("a", "b").where("a <> b")
    current = reliable_checkpoint(
        both.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    )
    signature = None
    for _ in range(rounds):
        if not current.take(1):
            break
        around = current.union(current.select("u", "v")).toDF("v", "u")
        lowest = around.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("k"), F.least("v", "m").alias("m"))
        large = (
            around.where("u > v").join(lowest, F.col("v") == F.col("k"))
            .select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        )
        large = large.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
        lowest = large.groupBy("v").agg(F.min("u").alias("m")).withColumnRenamed("v", "k")
        small = large.join(lowest, F.col("v") == F.col("k"))
        small = (
            small.select(F.col("u").alias("v"), F.col("m").alias("u"))
            .union(lowest.select(F.col("k").alias("v"), F.col("m").alias("u")))
            .where("v <> u").distinct()
        )
        current = reliable_checkpoint(small)
        found = current.agg(
            F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.count_distinct("v")
        ).first()
        # Stars: every node but the centres hangs on exactly one node, and nothing moved.
        if tuple(found) == signature:
            break
        signature = tuple(found)
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    label = current.groupBy("v").agg(F.min("u").alias("label")).withColumnRenamed("v", "node")
    return label.union(label.select(F.col("label").alias("node"), "label").distinct())
