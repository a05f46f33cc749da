"""Trigram similarity of short names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import sized_broadcast
from ..session import reliable_checkpoint


def trigrams(name: Column) -> Column:
    """Distinct three-letter pieces of the lower-case words, padded two before and one after."""
    words = F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    pieces = F.transform(
        F.transform(words, lambda word: F.concat(F.lit("  "), word, F.lit(" "))),
        lambda padded: F.transform(
            F.sequence(F.lit(1), F.length(padded) - 2), lambda i: padded.substr(i, F.lit(3))
        ),
    )
    return F.array_distinct(F.flatten(pieces))


def similarity(left: Column, right: Column) -> Column:
    """Shared trigrams over all trigrams of both names; 0 if both have none."""
    shared = F.size(F.array_intersect(left, right))
    total = F.size(left) + F.size(right) - shared
    return F.when(total > 0, shared / total).otherwise(F.lit(0.0))


def gram_code(gram: Column) -> Column:
    """A trigram as one number (21 bits per character, so no two share one)."""
    def char(i: int) -> Column:
        return F.ascii(F.substring(gram, i, 1)).cast("long")

    return F.shiftleft(char(1), 42) + F.shiftleft(char(2), 21) + char(3)


# Rows of one trigram that one task joins; a more frequent trigram is split.
HOT_GRAM = 2_000
MOST_SALTS = 256


def similar_names(
    left: DataFrame, left_name: str, right: DataFrame, right_name: str, threshold: float = 0.3
) -> DataFrame:
    """All name pairs with similarity above ``threshold``: (left_name, right_name, score).

    Two names that similar must share a trigram among the rarest few of each, so
    only those are joined on. A candidate carries sizes and places, no trigrams: the
    sizes must fit, and from the shared trigram on both names must have enough
    trigrams left. Trigrams come back for the pairs that remain, which are scored.
    """
    names_l = left.select(F.col(left_name).alias("name")).filter("name is not null").distinct()
    names_r = right.select(F.col(right_name).alias("name")).filter("name is not null").distinct()
    both = names_l.withColumn("side", F.lit("l")).unionByName(names_r.withColumn("side", F.lit("r")))
    pieces = both.select("side", "name", F.explode(trigrams(F.col("name"))).alias("gram")).withColumn(
        "gram", gram_code(F.col("gram"))
    )
    rarity = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
    ordered = reliable_checkpoint(
        pieces.join(sized_broadcast(rarity), "gram")
        .groupBy("side", "name")
        .agg(F.sort_array(F.collect_list(F.struct("seen", "gram"))).alias("ranked"))
        .withColumn("size", F.size("ranked"))
    )
    needed = F.ceil(F.col("size") * F.lit(threshold))
    prefixed = ordered.select(
        "side", "name", "size", F.posexplode(F.slice("ranked", F.lit(1), (F.col("size") - needed + 1).cast("int"))).alias("place", "piece")
    )
    salts = F.least(F.ceil(F.col("piece.seen") / HOT_GRAM), F.lit(MOST_SALTS)).cast("int")

    def side(label: str, salt: Column) -> DataFrame:
        return prefixed.filter(F.col("side") == label).select(
            F.col("name").alias(f"name_{label}"), F.col("size").alias(f"size_{label}"),
            (F.col("size") - F.col("place")).alias(f"rest_{label}"), F.col("piece.gram").alias("gram"), salt.alias("salt"),
        )

    spread = side("l", F.pmod(F.xxhash64("name"), salts).cast("int"))
    copied = side("r", F.explode(F.sequence(F.lit(0), salts - 1)))
    size_l, size_r = F.col("size_l"), F.col("size_r")
    shared = (size_l + size_r) * F.lit(threshold / (1 + threshold)) - 1e-9
    fits = (
        (size_l >= size_r * F.lit(threshold)) & (size_r >= size_l * F.lit(threshold))
        & (F.least("rest_l", "rest_r") >= shared)
    )
    pairs = spread.join(copied, ["gram", "salt"]).filter(fits).select("name_l", "name_r").distinct()

    def grams(label: str) -> DataFrame:
        return ordered.filter(F.col("side") == label).select(
            F.col("name").alias(f"name_{label}"), F.col("ranked.gram").alias(f"grams_{label}")
        )

    scored = pairs.join(grams("l"), "name_l").join(grams("r"), "name_r").select(
        F.col("name_l").alias(left_name), F.col("name_r").alias(right_name),
        similarity(F.col("grams_l"), F.col("grams_r")).alias("score"),
    )
    return scored.filter(F.col("score") > threshold)
