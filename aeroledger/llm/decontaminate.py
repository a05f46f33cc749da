"""Benchmark decontamination by a prefix-filtered set join, as DataFrame operations only.

A window is ``window_words`` consecutive words of a benchmark item, or the whole item if it has
fewer. A document holds a window only if it holds each of the window's shingles, so one shingle is the
whole necessary prefix: the rarest in the documents. Document positions meet windows on that shingle's
hash. The shingle's offset fixes where the window would have to start; it must start in the document
(positional bound) and end in it (length bound), and then its words are compared one by one.

The vocabulary of shingles and the anchors are broadcast only after they were counted
(``sized_broadcast``); larger ones are joined through a shuffle, for which a position carries no more
than the words around it.

Cases: null text has no words; an item without words has no window; repeated rows of a document each
have their row; repeated items count once by their id; words hit by an item without id are hit, the item
is not listed; empty tables give no hits or no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import sized_broadcast
from ..session import reliable_checkpoint
from .common import free_name

WINDOW_WORDS = 10
SHINGLE_WORDS = 3

#: Fixed value: everything that is no word character, after A-Z became a-z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words in order; only A-Z are lower-cased (for plain ASCII the faster function does the same)."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, NO_WORD), "")


def document_key() -> Column:
    """Rows of equal id and text have equal results, so they share a key."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("/"), F.md5(F.coalesce("text", F.lit(""))))


def windows(benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Distinct ``item_id, window``; a window is an array of words."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window_words, F.lit(0)))
    exploded = items.select("item_id", "words", F.explode(starts).alias("start"))
    return exploded.select("item_id", F.slice("words", F.col("start") + 1, window_words).alias("window")).distinct()


def shingle_at(words: str, position: Column, size: int) -> Column:
    """Hash of ``size`` words from a position on."""
    return F.xxhash64(F.lit(size), *[F.get(F.col(words), position + k) for k in range(size)])


def window_shingles(held: DataFrame, shingle_words: int) -> DataFrame:
    """``size, offset, shingle`` of every place in every window; short windows are one shingle."""
    sized = held.withColumn("size", F.least(F.size("window"), F.lit(shingle_words)))
    placed = sized.select("*", F.explode(F.sequence(F.lit(0), F.size("window") - F.col("size"))).alias("offset"))
    hashed = F.lit(None).cast("long")
    for size in range(1, shingle_words + 1):
        hashed = F.when(F.col("size") == size, shingle_at("window", F.col("offset"), size)).otherwise(hashed)
    return placed.withColumn("shingle", hashed)


def document_shingles(documents: DataFrame, sizes: list[int], context: int | None) -> DataFrame:
    """``doc_key, n_words, position, shingle`` and, with ``context``, the words around the position.

    The outer generator keeps the words from being split twice (a plain one adds a
    filter on their number below the projection).
    """
    base = documents.select(document_key().alias("doc_key"), words_of(F.col("text")).alias("words"))
    if context is None:
        base = base.select("words")
    exploded = base.select("*", F.posexplode_outer("words").alias("position", "word"))
    shingles = F.array(*[shingle_at("words", F.col("position"), size) for size in sizes])
    columns = [] if context is None else [
        "doc_key", "position", F.size("words").alias("n_words"),
        F.greatest(F.col("position") - context + 1, F.lit(0)).alias("around_start"),
        F.slice("words", F.greatest(F.col("position") - context + 1, F.lit(0)) + 1, 2 * context).alias("around"),
    ]
    if len(sizes) == 1:
        return exploded.select(*columns, shingle_at("words", F.col("position"), sizes[0]).alias("shingle"))
    return exploded.select(*columns, F.explode(shingles).alias("shingle"))


def anchors(documents: DataFrame, held: DataFrame, shingle_words: int, sizes: list[int]) -> DataFrame:
    """``item_id, window, offset, shingle``: each window at its rarest shingle.

    Rarity is the number of places in all documents; ties go to the smaller hash.
    """
    places = window_shingles(held, shingle_words)
    vocabulary = sized_broadcast(places.select("shingle").distinct())
    counted = document_shingles(documents, sizes, None).join(vocabulary, "shingle").groupBy("shingle").agg(
        F.count("*").alias("places")
    )
    ranked = places.join(counted, "shingle", "left").select(
        "item_id", "window", F.struct(F.coalesce("places", F.lit(0)).alias("places"), "shingle", "offset").alias("rank")
    )
    rarest = ranked.groupBy("item_id", "window").agg(F.min("rank").alias("rank"))
    # A window whose rarest shingle occurs nowhere cannot occur.
    return rarest.where("rank.places > 0").select("item_id", "window", "rank.offset", "rank.shingle")


def occurrences(
    documents: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """Distinct ``doc_key, start, length, item_id`` of every window in every document."""
    held = reliable_checkpoint(windows(benchmark, window_words))
    sizes = sorted(r[0] for r in held.select(F.least(F.size("window"), F.lit(shingle_words))).distinct().collect())
    if not sizes:
        sizes = [shingle_words]
    found = sized_broadcast(anchors(documents, held, shingle_words, sizes))
    near = document_shingles(documents, sizes, window_words)
    start = F.col("position") - F.col("offset")
    length = F.size("window")
    joined = near.join(found, "shingle").where((start >= 0) & (start + length <= F.col("n_words")))
    verified = joined.where(F.slice("around", start - F.col("around_start") + 1, length) == F.col("window"))
    return verified.select("doc_key", start.alias("start"), length.alias("length"), "item_id").distinct()


def contamination(
    documents: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """Per document its words, the words that a window covers, and the items whose windows occur."""
    found = reliable_checkpoint(occurrences(documents, benchmark, window_words, shingle_words))
    covered = found.select("doc_key", "start", "length").distinct().select(
        "doc_key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place")
    )
    hits = covered.distinct().groupBy("doc_key").agg(F.count("*").alias("n_hit"))
    named = found.select("doc_key", F.col("item_id").cast("string").alias("item")).distinct().groupBy("doc_key").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )
    by_document = hits.join(named, "doc_key")
    rows = documents.select("doc_id", document_key().alias("doc_key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(by_document, "doc_key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(
    documents: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """The rows of ``documents`` in which no window occurs, all columns kept."""
    key = free_name(documents, "hit_key")
    found = occurrences(documents, benchmark, window_words, shingle_words).select(F.col("doc_key").alias(key)).distinct()
    keyed = documents.withColumn(key, document_key())
    return keyed.join(found, key, "left_anti").select(*documents.columns)
