"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint has 64 bits. It is split into ``bits + 3`` blocks; two fingerprints that
differ in at most ``bits`` bits agree on at least three whole blocks, so they meet in
a bucket for some choice of three blocks. Equal fingerprints are one row before any
join, so copies never meet each other. Bucket members are compared pair by pair.

A bucket of more than ``BUCKET_PAIRS`` distinct fingerprints would cost the square of
its size. Its members take an exact way of linear size instead: every fingerprint within
one bit of a centre lies within ``bits`` of every fingerprint within ``bits - 1`` of
that centre, and each linked pair has such a centre. So one link from each member
to the smallest member around the centre gives the same components as all pairs.

Cases: null text is empty; a text without words has fingerprint zero and is linked like
any other; rows with equal ids each keep their row; a null id keeps its row and names
a component only if no id in it is known. An empty table gives no rows. Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from . import common

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Distinct fingerprints of one bucket that are compared pair by pair.
BUCKET_PAIRS = 48
# Shingles that are hashed before their bits are added up.
CHUNK = 1 << 15

UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint_of(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text; texts of any length in bounded extra memory."""
    words = WORD.findall(text.translate(UPPER_TO_LOWER))
    if not words:
        return 0
    size = min(shingle_words, len(words))
    total = len(words) - size + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, CHUNK):
        end = min(total, start + CHUNK)
        columns = (words[start + k : end + k] for k in range(size))
        hashes = np.array([digest(" ".join(s), SEED) for s in zip(*columns)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > total)))


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, text_key, fp)`` per row, ``fp`` as signed long, ``text_key`` the text's MD5."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text_key, raw in rows:
            yield doc_id, text_key, signed(fingerprint_of(common.decode(raw), shingle_words))

    raw = common.text_bytes("text")
    narrow = documents.select("doc_id", F.md5(raw).alias("text_key"), raw.alias("raw"))
    return common.map_rows(narrow, run, "doc_id long, text_key string, fp long")


def block_masks(bits: int = MAX_BITS) -> list[int]:
    """Masks of every choice of three blocks out of ``bits + 3``."""
    blocks = bits + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(single, 3)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(distinct: DataFrame, bits: int = MAX_BITS, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints within ``bits`` (1 or more) of each other.

    ``distinct`` holds each fingerprint once. From small buckets every close pair
    comes as it is; members of large buckets are connected around shared centres.
    """
    masks = [signed(m) for m in block_masks(bits)]
    choices = F.array(*[
        F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)
    ])
    keyed = distinct.select("fp", F.explode(choices).alias("block")).select("fp", "block.which", "block.part")
    sizes = keyed.groupBy("which", "part").agg(F.count("*").alias("members")).where("members > 1")
    sizes = reliable_checkpoint(sizes)
    shared = keyed.join(sizes, ["which", "part"])
    small = shared.where(F.col("members") <= bucket_pairs).select("which", "part", "fp")
    left, right = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    pairs = left.join(right, ["which", "part"]).where(close).select("a", "b").distinct()

    crowded = shared.where(F.col("members") > bucket_pairs).select("fp").distinct()
    return pairs.union(around_centres(crowded, bits))


def flips(count: int) -> list[int]:
    """Masks with at most ``count`` of 64 bits set."""
    return [signed(sum(1 << b for b in chosen)) for n in range(count + 1) for chosen in combinations(range(64), n)]


def around_centres(members: DataFrame, bits: int) -> DataFrame:
    """Edges that join all members within ``bits`` of each other through common centres."""
    def ball(radius):
        rows = members.select("fp", F.explode(F.array(*map(F.lit, flips(radius)))).alias("flip"))
        return rows.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"), "fp")

    near = ball(min(1, bits - 1))
    hubs = near.groupBy("centre").agg(F.min("fp").alias("hub"))
    around = near.select("centre", "fp").union(ball(max(1, bits - 1)))
    edges = around.join(hubs, "centre").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    return edges.where("a <> b").distinct()


def marked_rows(documents: DataFrame, shingle_words: int, bits: int, bucket_pairs: int) -> DataFrame:
    """``doc_id, text_key, fp, component_id`` per row; ``text_key`` tells texts of one id apart."""
    marked = reliable_checkpoint(fingerprints(documents, shingle_words))
    first = reliable_checkpoint(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = common.components(links(first.select("fp"), bits, bucket_pairs))
    grouped = first.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp")
    )
    lowest = grouped.groupBy("label").agg(F.min("first_id").alias("component_id"))
    component = grouped.join(lowest, "label").select("fp", "label", "component_id")
    return marked.join(component, "fp")


def near_duplicates(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS, bucket_pairs: int = BUCKET_PAIRS
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (smallest ``doc_id`` in reach)."""
    return marked_rows(documents, shingle_words, bits, bucket_pairs).select("doc_id", "fp", "component_id")


def one_per_group(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS, bucket_pairs: int = BUCKET_PAIRS
) -> DataFrame:
    """The rows of ``documents`` that stand for their group, all columns kept.

    The row with the smallest id stays (null ids last, then the smallest text
    digest); of rows that repeat that id and text, one.
    """
    key = common.free_name(documents, "kept_row")
    marked = marked_rows(documents, shingle_words, bits, bucket_pairs)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = marked.groupBy("label").agg(F.min(order).alias("row"))
    kept = kept.select(row_key(F.col("row.doc_id"), F.col("row.text_key")).alias(key))
    keyed = documents.withColumn(key, row_key(F.col("doc_id"), F.md5(common.text_bytes("text"))))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*documents.columns)


def row_key(doc_id, text_key):
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("/"), text_key)
