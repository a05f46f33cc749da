"""Merkle manifest of a table: hash trees per source, and proofs by a recursive query.

``build`` numbers the leaves of every source, folds blocks of ``BLOCK`` leaves level by level, then blocks of the
nodes that remain, until each source has one; the subroots are the leaves of one more tree. The levels are node rows
with their siblings and a link to the parent. A recursive query climbs those rows: every leaf ascends by one link a
step, appends the siblings it meets and folds its own, perhaps tampered, hash with them.

A block of leaves is a ``home``. What lies above a home is the same for all its leaves, so the same kind of query
climbs from the homes' tops to the root, a level a step, and leaves the way as one link per home. Links within a home
lead up ``LINK_LEVELS`` levels. So no step joins more than ``BLOCK`` leaves on one node, also in a source with a third
of the rows, and a leaf's row is shuffled once for each link, not for each level.

Digests are held as 32 bytes and hashed as lower-case hex text.

Cases: null columns hash as ``-``, a null source is a source and the first one; null ids come first, rows of equal
id follow their leaves' digests, and rows equal in all columns are leaves of their own; null and empty texts differ;
a tampered text is its text without line breaks, so one without any is verified; long texts are hashed where they are
read; a table without rows gives none, one of a single row has its leaf as root; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, run_dir
from . import ranks

FANOUT = 3
BLOCK_LEVELS = 6
BLOCK = FANOUT**BLOCK_LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Name of the tree over the subroots; sources' trees are named '' or '=' and the source.
TOP = "!"
# Levels that a link within a home leads up.
LINK_LEVELS = 3
# Place of a home's link to the root; other links are at level times ``BLOCK``, plus the node's place on that level.
HOME_TOP = -1
# More levels than any table can have.
MAX_LEVELS = 200

ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(raw: Column) -> Column:
    """32 bytes of the SHA-256 of digests as hex text; ``raw`` holds the digests as bytes, one behind the other."""
    return F.unhex(F.sha2(F.lower(F.hex(raw)).cast("binary"), 256))


def as_hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of a row: every value with its length before it, ``-`` where it is null."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(documents: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, changed, idx``: place, digest and tampered digest of every row."""
    *plain, text = (F.col(c) for c in COLUMNS)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    changed = F.when(tampered, leaf_digest([*plain, F.replace(text, F.lit("\n"), F.lit(""))]))
    rows = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"), "doc_id",
        leaf_digest([*plain, text]).alias("leaf"), changed.alias("changed"),
    )
    alike = rows.groupBy("tree", "doc_id", "leaf", "changed").agg(F.count("*").alias("copies"))
    return ranks.expanded(ranks.ranked(alike, ["tree"], ["doc_id", "leaf"]), "idx")


def _runs(level: Column) -> Column:
    """The parents of a block's nodes of one level."""
    def member(run: Column, n: int) -> Column:
        return F.coalesce(F.get(level, run * FANOUT + n), F.lit(b""))

    last = F.floor((F.size(level) + FANOUT - 1) / FANOUT).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda run: digest(F.concat(*(member(run, n) for n in range(FANOUT)))))


def _folded(nodes: DataFrame, base: int, extra: tuple[str, ...]) -> DataFrame:
    """Blocks of ``tree, idx, hash`` with all their levels up to the block's single top.

    ``height`` levels lie above the lowest one; a tree that fits into one block ends there.
    """
    sizes = nodes.groupBy("tree").agg((F.max("idx") + 1).alias("tree_size"))
    blocks = nodes.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "hash", *extra))).alias("members")
    )
    need = F.lit(BLOCK_LEVELS)
    for level in reversed(range(BLOCK_LEVELS)):
        need = F.when(F.col("tree_size") <= FANOUT**level, level).otherwise(need)
    rows = blocks.join(sizes, "tree").withColumn("height", need).withColumn("lowest", F.array("members.hash"))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.col("height")), F.col("lowest"),
        lambda levels, _: F.concat(levels, F.array(_runs(F.element_at(levels, -1)))),
    )
    return rows.select(
        "tree", "block", "height", (F.col("tree_size") <= BLOCK).alias("whole"), F.lit(base).alias("base"), "members",
        F.when(F.col("height") == 0, F.col("lowest")).otherwise(grown).alias("levels"),
        F.monotonically_increasing_id().alias("home"),
    )


def _tops() -> Column:
    return F.element_at("levels", -1)[0].alias("hash")


def _fold_up(nodes: DataFrame, extra: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every pass, and ``tree, hash`` of each tree's last node."""
    passes: list[DataFrame] = []
    while True:
        blocks = reliable_checkpoint(_folded(nodes, BLOCK_LEVELS * len(passes), extra))
        passes.append(blocks)
        rest = blocks.where(~F.col("whole"))
        if not rest.take(1):
            break
        nodes, extra = rest.select("tree", F.col("block").alias("idx"), _tops()), ()
    return passes, _union([b.where("whole").select("tree", _tops()) for b in passes])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _siblings(row: Column, at: Column) -> tuple[Column, Column]:
    """Digests left and right of a node in its run, each side as one value."""
    first = at - at % FANOUT

    def side(wanted) -> Column:
        parts = (F.when(wanted(first + n), F.get(row, first + n)) for n in range(FANOUT))
        return F.concat(*(F.coalesce(p, F.lit(b"")) for p in parts))

    return side(lambda place: place < at), side(lambda place: place > at)


def _nodes(blocks: DataFrame) -> DataFrame:
    """A row per node below its block's top: ``level`` and ``at`` within the block, ``lefts`` and ``rights``."""
    levels = blocks.select(
        "home", "tree", "block", "height", "whole", "base", F.posexplode("levels").alias("level", "row")
    ).where(F.col("level") < F.col("height"))
    nodes = levels.select("*", F.posexplode("row").alias("at", "hash"))
    lefts, rights = _siblings(F.col("row"), F.col("at"))
    return nodes.withColumn("lefts", lefts).withColumn("rights", rights).drop("row", "hash")


def _links(first: int, at: Column) -> Column:
    """The siblings on the way up from a block's node: a pair for each of ``LINK_LEVELS`` levels, or to the top."""
    width = F.array(*(F.lit(FANOUT**n) for n in range(LINK_LEVELS)))
    last = F.least(F.col("height"), F.lit(first + LINK_LEVELS)) - 1

    def pair(level: Column) -> Column:
        place = F.floor(at / F.get(width, level - first)).cast("int")
        lefts, rights = _siblings(F.get(F.col("levels"), level), place)
        return F.struct(lefts.alias("lefts"), rights.alias("rights"))

    none = F.array().cast("array<struct<lefts: binary, rights: binary>>")
    return F.when(F.col("height") > first, F.transform(F.sequence(F.lit(first), last), pair)).otherwise(none)


def _up(first: int, at: Column) -> Column:
    """Place of the next link."""
    over = first + LINK_LEVELS
    return F.when(F.col("height") > over, over * BLOCK + F.floor(at / FANOUT**LINK_LEVELS).cast("int")).otherwise(HOME_TOP)


def _recursion(spark: SparkSession, start: DataFrame, nodes: DataFrame, query: str, label: str) -> DataFrame:
    """Run a recursive query over ``starts`` and ``nodes`` and store its rows.

    Spark's bound on the rows of a recursion is lifted for this query alone.
    """
    target = run_dir(spark, label)
    starts, links = f"starts_{label}", f"nodes_{label}"
    start.createOrReplaceTempView(starts)
    nodes.createOrReplaceTempView(links)
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        spark.sql(query.format(starts=starts, nodes=links, levels=MAX_LEVELS)).write.parquet(target)
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)
        spark.catalog.dropTempView(starts)
        spark.catalog.dropTempView(links)
    return spark.read.parquet(target)


# From the homes' tops to the root: which siblings lie above each home, step by step.
PATHS = """
with recursive path (home, step, tree, level, idx, lefts, rights) max recursion level {levels} as (
    select home, 0, tree, level, idx, cast(null as binary), cast(null as binary) from {starts}
    union all
    select p.home, p.step + 1, n.up_tree, n.up_level, n.up_idx, n.lefts, n.rights
    from path p join {nodes} n on p.tree = n.tree and p.level = n.level and p.idx = n.idx
)
select home, step, lefts, rights from path where step > 0
"""

# Every leaf to the root: at each link its hash is folded with the siblings, which are appended to those met before.
CLIMB = """
with recursive climb (home, doc_id, leaf, subroot, place, fold, met) max recursion level {levels} as (
    select home, doc_id, leaf, cast(null as binary), place, fold, met from {starts}
    union all
    select c.home, c.doc_id, c.leaf, n.subroot, n.up,
        aggregate(n.links, c.fold, (f, s) -> unhex(sha2(cast(lower(hex(concat(s.lefts, f, s.rights))) as binary), 256))),
        aggregate(n.links, c.met, (m, s) -> concat(m, s.lefts, s.rights))
    from climb c join {nodes} n on c.home = n.home and c.place = n.place
)
select doc_id, leaf, subroot, fold, sha2(cast(lower(hex(met)) as binary), 256) as proof_sha256 from climb where place is null
"""


def build(documents: DataFrame) -> dict:
    """All levels of a table: ``homes`` (leaf blocks), ``nodes`` and ``trees`` (place and digest of every subroot); the ``root``."""
    passes, subroots = _fold_up(leaves(documents).withColumnRenamed("leaf", "hash"), ("doc_id", "changed"))
    placed = ranks.ranked(subroots.select(F.lit(0).alias("one"), "*", F.lit(1).alias("copies")), ["one"], ["tree"])
    trees = reliable_checkpoint(placed.select("tree", F.col("first").alias("rank"), F.col("hash").alias("subroot")))
    top, root = _fold_up(trees.select(F.lit(TOP).alias("tree"), F.col("rank").alias("idx"), F.col("subroot").alias("hash")))
    found = root.first()
    return {
        "homes": passes[0].join(trees, "tree"), "trees": trees, "root": bytes(found["hash"]) if found else None,
        "nodes": _upper([b.join(trees, "tree") for b in passes[1:]] + [b.withColumn("rank", F.lit(None).cast("long")) for b in top]),
    }


def _upper(passes: list[DataFrame]) -> DataFrame:
    """Parent-linked rows of the nodes above the homes; a subroot's place is in the top tree."""
    width = F.element_at(F.array(*(F.lit(FANOUT**n) for n in range(BLOCK_LEVELS, -1, -1))), F.col("level") + 1)
    rows = []
    for blocks in passes:
        nodes = _nodes(blocks).join(blocks.select("home", "rank"), "home")
        place = nodes.withColumn("idx", F.col("block") * width + F.col("at"))
        last = F.col("whole") & (F.col("level") + 1 == F.col("height")) & F.col("rank").isNotNull()
        rows.append(place.select(
            "tree", (F.col("base") + F.col("level")).alias("level"), "idx", "lefts", "rights",
            F.when(last, F.lit(TOP)).otherwise(F.col("tree")).alias("up_tree"),
            F.when(last, 0).otherwise(F.col("base") + F.col("level") + 1).alias("up_level"),
            F.when(last, F.col("rank")).otherwise(F.floor(F.col("idx") / FANOUT)).alias("up_idx"),
        ))
    return reliable_checkpoint(_union(rows))


def climb(tree: dict) -> DataFrame:
    """``doc_id, leaf, subroot, fold, proof_sha256``: what every leaf has when it is at the root."""
    homes = tree["homes"]
    spark = homes.sparkSession
    tops = homes.select(
        "home", F.when(F.col("whole"), F.lit(TOP)).otherwise(F.col("tree")).alias("tree"),
        F.when(F.col("whole"), 0).otherwise(F.col("height")).alias("level"),
        F.when(F.col("whole"), F.col("rank")).otherwise(F.col("block")).alias("idx"),
    )
    ways = _recursion(spark, tops, tree["nodes"], PATHS, "merkle_paths").groupBy("home").agg(
        F.array_sort(F.collect_list(F.struct("step", "lefts", "rights"))).alias("way")
    )
    pairs = F.transform(F.coalesce("way", F.array()), lambda s: F.struct(s["lefts"].alias("lefts"), s["rights"].alias("rights")))
    above = homes.select("home", "subroot").join(ways, "home", "left").select(
        "home", F.lit(HOME_TOP).alias("place"), F.lit(None).cast("int").alias("up"), pairs.alias("links"), "subroot"
    )
    at = F.col("at")
    parts = [above]
    for first in range(LINK_LEVELS, BLOCK_LEVELS, LINK_LEVELS):
        nodes = homes.where(F.col("height") > first).select("home", "height", "levels", F.posexplode(F.get("levels", F.lit(first))).alias("at", "hash"))
        parts.append(nodes.select(
            "home", (first * BLOCK + at).alias("place"), _up(first, at).alias("up"), _links(first, at).alias("links"), F.lit(None).cast("binary").alias("subroot")
        ))
    nodes = reliable_checkpoint(_union(parts))
    # The lowest link is at hand in the block, so a leaf starts with it done.
    members = homes.select("home", "height", "levels", F.posexplode("members").alias("at", "member"))
    linked = members.select("home", "member", _up(0, at).alias("place"), _links(0, at).alias("links"))
    own = F.coalesce("member.changed", "member.hash")
    starts = linked.select(
        "home", "member.doc_id", F.col("member.hash").alias("leaf"), "place",
        F.aggregate("links", own, lambda f, s: digest(F.concat(s["lefts"], f, s["rights"]))).alias("fold"),
        F.aggregate("links", F.lit(b""), lambda m, s: F.concat(m, s["lefts"], s["rights"])).alias("met"),
    )
    return _recursion(spark, starts, nodes, CLIMB, "merkle_climb")


def proofs(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row."""
    tree = build(documents)
    root = F.lit(tree["root"]).cast("binary")
    return climb(tree).select(
        "doc_id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), as_hex(root).alias("root"),
        "proof_sha256", as_hex(F.col("fold")).alias("folded_root"), (F.col("fold") == root).alias("verified"),
    )
