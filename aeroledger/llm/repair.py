"""Cheapest repair of conversations whose turns were lost, emptied, doubled or given to the wrong side.

A row is one of a few kinds: the role it begins with, and whether it must go, lacks its end, or is sound. A block of
``BLOCK`` rows is a text of such kinds. For every state that a conversation can be in before a block, a dynamic
program finds the cheapest edits to each state after it. Edit lists are nodes that share their prefixes (``Edits``):
a node knows its ancestors at distances of powers of two and a rolling hash of its whole list, so of two lists of
equal cost the lesser is found by a search for their longest common prefix, which is then verified.

Blocks are composed in the same way: an item is a block's table, its symbols say which of the block's lists, in
their order, was taken. Lists that come from one state end in an edit of a row, so none is the beginning of another
and the first block in which two lists differ decides. So a conversation of any length is cut into many tasks.

Order of rows: turn (null first), role, SHA-256 of the text. Cases: null role or text is one space; a null id is a
conversation; equal rows are counted, and all but the first are duplicates; a conversation without rows has no
edits; roles are told by their first character, and unknown ones can only be deleted or given to another role; long
texts are hashed where they are read; empty tables give empty tables; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from . import ranks
from .common import map_rows

# Rows of one block, and blocks (of blocks) that are composed at once.
BLOCK = 1024
# Tables of blocks that a worker remembers; most conversations look like many others.
KNOWN_BLOCKS = 20_000

#: What the edits cost, and the states (nothing yet, or the role of the last turn).
COST = {"K": 0, "D": 4, "I": 3, "R": 3}
TRUNCATED_COST = 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# Insertions that end a conversation from each state.
ENDINGS = {START: "", ASSISTANT: "", USER: "a", SYSTEM: "ua"}
ROLE_NAMES = {"u": "user", "a": "assistant"}

# Kinds of rows, one character each: role s, u, a or another; sound, truncated, to be deleted.
SOUND, TRUNCATED, DELETED = "suao", "SUAO", "1234"

BASE, MODULUS = 1_000_003, (1 << 61) - 1


class Edits:
    """Lists of symbols as nodes that share their prefixes; node 0 is the empty list."""

    def __init__(self):
        self.symbol, self.length, self.hash, self.up = [-1], [0], [0], [()]

    def extended(self, node: int, symbols) -> int:
        for symbol in symbols:
            jumps, at = [node], node
            while len(self.up[at]) >= len(jumps):
                at = self.up[at][len(jumps) - 1]
                jumps.append(at)
            self.symbol.append(symbol)
            self.length.append(self.length[node] + 1)
            self.hash.append((self.hash[node] * BASE + symbol + 1) % MODULUS)
            self.up.append(tuple(jumps))
            node = len(self.symbol) - 1
        return node

    def listed(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]

    def _cut(self, node: int, length: int) -> int:
        while self.length[node] > length:
            jump = (self.length[node] - length).bit_length() - 1
            node = self.up[node][jump]
        return node

    def _same(self, one: int, other: int) -> bool:
        """Whether two lists of equal length are equal, symbol by symbol back to a shared node."""
        while one != other:
            if self.symbol[one] != self.symbol[other]:
                return False
            one, other = self.up[one][0], self.up[other][0]
        return True

    def less(self, one: int, other: int) -> bool:
        """Whether one list comes before the other."""
        shared = min(self.length[one], self.length[other])
        x, y = self._cut(one, shared), self._cut(other, shared)
        if self.hash[x] == self.hash[y]:
            if self._same(x, y):
                return self.length[one] < self.length[other]
            return self.listed(one) < self.listed(other)
        for jump in range(len(self.up[x]) - 1, -1, -1):
            if jump < len(self.up[x]) and self.hash[self.up[x][jump]] != self.hash[self.up[y][jump]]:
                x, y = self.up[x][jump], self.up[y][jump]
        if not self._same(self.up[x][0], self.up[y][0]):  # unequal lists of one hash
            return self.listed(one) < self.listed(other)
        return self.symbol[x] < self.symbol[y]


# ---- the dynamic program ---------------------------------------------------------------

@lru_cache(maxsize=None)
def row_edges(kind: str) -> tuple:
    """The cheapest edits of one row from state to state, insertions before it included: ``(from, to, cost, edits)``."""
    role = "suao"[(SOUND + TRUNCATED + DELETED).index(kind) % 4]
    late = TRUNCATED_COST if kind in TRUNCATED else 0
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for begin in range(4):
        reach = [(begin, 0, "")]
        for _ in range(3):
            reach += [(NEXT[r][at], cost + COST["I"], edits + "I") for at, cost, edits in reach for r in "ua" if at in NEXT[r]]
        for at, cost, edits in reach:
            options = [(at, cost + COST["D"], edits + "D")]
            if kind not in DELETED:
                options += [(NEXT[r][at], cost + late + COST["R"], edits + "R") for r in "ua" if r != role and at in NEXT[r]]
                if at in NEXT.get(role, {}):
                    options.append((NEXT[role][at], cost + late, edits + "K"))
            for to, total, text in options:
                best[begin, to] = min(best.get((begin, to), (total, text)), (total, text))
    return tuple((begin, to, cost, tuple(map(ord, text))) for (begin, to), (cost, text) in sorted(best.items()))


def table_edges(costs, order) -> tuple:
    """The same for a block's table: the symbol is the list's place among those from its state."""
    return tuple((i // 4, i % 4, costs[i], (order[i],)) for i in range(16) if costs[i] is not None)


def walked(items, begin: int):
    """The program over ``items`` (edges each) from one state: edits, and per state (cost, node) at the end."""
    edits, ahead = Edits(), [None] * 4
    ahead[begin] = (0, 0)
    for edges in items:
        best: list = [None] * 4
        for start, to, cost, symbols in edges:
            if ahead[start] is None:
                continue
            total, held = ahead[start][0] + cost, best[to]
            if held is None or total < held[0]:
                best[to] = (total, start, symbols, None)
            elif total == held[0]:
                mine = edits.extended(ahead[start][1], symbols)
                theirs = held[3] or edits.extended(ahead[held[1]][1], held[2])
                best[to] = (total, start, symbols, mine) if edits.less(mine, theirs) else (*held[:3], theirs)
        ahead = [b and (b[0], b[3] or edits.extended(ahead[b[1]][1], b[2])) for b in best]
    return edits, ahead


def table(items, begins=range(4)) -> tuple[list, list]:
    """Cost, and place among the lists from the same state, of the best list from each state to each."""
    costs: list = [None] * 16
    order: list = [None] * 16
    for begin in begins:
        edits, ahead = walked(items, begin)
        lists = sorted((edits.listed(a[1]), to) for to, a in enumerate(ahead) if a)
        for place, (_, to) in enumerate(lists):
            costs[4 * begin + to], order[4 * begin + to] = ahead[to][0], place
    return costs, order


@lru_cache(maxsize=KNOWN_BLOCKS)
def row_table(kinds: str, first: bool) -> tuple[list, list]:
    return table([row_edges(k) for k in kinds], (START,) if first else range(4))


@lru_cache(maxsize=KNOWN_BLOCKS)
def row_audit(kinds: str, begin: int, to: int) -> str:
    edits, ahead = walked([row_edges(k) for k in kinds], begin)
    return "".join(map(chr, edits.listed(ahead[to][1])))


def child_states(tables, begin: int, to: int) -> list[tuple[int, int]]:
    """The states before and after each of the blocks on the best way between two states."""
    edits, ahead = walked([table_edges(*t) for t in tables], begin)
    way, at = [], begin
    for (_, order), place in zip(tables, edits.listed(ahead[to][1])):
        after = next(s for s in range(4) if order[4 * at + s] == place)
        way.append((at, after))
        at = after
    return way


def illegal_pairs(roles: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(roles, roles[1:])))


def roles_of(kinds: str) -> str:
    return kinds.lower().translate(str.maketrans(DELETED, SOUND))


def ending(costs, order) -> int:
    """The state after the last row of the cheapest whole conversation, least among equals."""
    return min((s for s in range(4) if costs[s] is not None), key=lambda s: (costs[s] + COST["I"] * len(ENDINGS[s]), order[s]))


def row_edits(kinds: str, audit: str, state: int) -> Iterator[tuple[int, str, str | None, bool]]:
    """``place, inserted roles, new role, kept`` for every row that is kept or has insertions before it."""
    at, lead = 0, ""
    for edit in audit:
        if edit == "I":
            role = "a" if state == USER else "u"
            lead, state = lead + role, NEXT[role][state]
            continue
        role = None
        if edit == "R":
            role = "a" if state == USER else "u"
        if edit != "D":
            state = NEXT[role or roles_of(kinds[at])][state]
        if edit != "D" or lead:
            yield at, lead, ROLE_NAMES.get(role), edit != "D"
        at, lead = at + 1, ""


# ---- rows ------------------------------------------------------------------------------

def key_of(conv_id: Column) -> Column:
    """The conversation as text; a null id is one too."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the damage that each row's key decides."""
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"))
    name = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    hit = rows.withColumn("hit", F.pmod(F.crc32(name.cast("binary")), F.lit(20))).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return hit.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies"),
    )


def placed_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows with their texts, and without texts: place, copies and faults of each."""
    said = rows.select(key_of(F.col("conv_id")).alias("conv"), "turn", spaced("role").alias("role"), spaced("text").alias("text"), "copies")
    said = said.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    said = reliable_checkpoint(said.withColumn("said_id", F.monotonically_increasing_id()))
    seen = r"[^\x20\x09-\x0D]"
    narrow = said.select(
        "said_id", "conv", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "copies",
        (~F.col("text").rlike(seen)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"),
    )
    placed = reliable_checkpoint(ranks.ranked(narrow, ["conv"], ["turn", "role", "digest"]))
    again = placed.groupBy("conv", "role", "digest").agg(F.min("first").alias("seen_at"), F.count("*").alias("times"))
    marked = placed.join(again.where("times > 1").drop("times"), ["conv", "role", "digest"], "left")
    return said, reliable_checkpoint(marked.withColumn("again", F.coalesce(F.col("first") > F.col("seen_at"), F.lit(False))))


def faults(marked: DataFrame) -> DataFrame:
    """Per conversation ``gaps, blank, duplicate, truncated``."""
    blank, again = F.col("blank"), F.col("again")

    def total(value: Column, where: Column) -> Column:
        return F.sum(F.when(where, value).otherwise(0)).cast("long")

    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return marked.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), total(F.col("copies"), blank).alias("blank"),
        total(F.when(again, F.col("copies")).otherwise(F.col("copies") - 1), ~blank).alias("duplicate"),
        total(F.lit(1), ~blank & ~again & F.col("open")).alias("truncated"),
    )


def blocks_of(marked: DataFrame, size: int) -> DataFrame:
    """``conv, block, kinds``: the rows as texts of at most ``size`` kinds."""
    role = F.translate(F.substring("role", 1, 1), "suao", "1234")
    role = F.when(role.isin("1", "2", "3"), role).otherwise("4")
    kind = F.when(F.col("blank") | F.col("again"), role).when(F.col("open"), F.translate(role, DELETED, TRUNCATED)).otherwise(
        F.translate(role, DELETED, SOUND)
    )
    end = F.col("first") + F.col("copies")
    spans = marked.select(
        "conv", "first", end.alias("end"), kind.alias("kind"), role.alias("gone"),
        F.explode(F.sequence(F.floor(F.col("first") / size), F.floor((end - 1) / size))).alias("block"),
    )
    start, stop = F.greatest("first", F.col("block") * size), F.least("end", (F.col("block") + 1) * size)
    head = F.when(start == F.col("first"), F.col("kind")).otherwise(F.col("gone"))
    piece = F.concat(head, F.repeat("gone", (stop - start - 1).cast("int")))
    texts = spans.select("conv", "block", F.struct(start.alias("at"), piece.alias("piece")).alias("part"))
    return texts.groupBy("conv", "block").agg(F.array_join(F.array_sort(F.collect_list("part"))["piece"], "").alias("kinds"))


TABLE = "conv string, block long, costs array<long>, places array<int>, illegal long, head string, tail string"


def tabled(blocks: DataFrame) -> DataFrame:
    """The table of every block."""
    def run(rows):
        for conv, block, kinds in rows:
            roles = roles_of(kinds)
            yield conv, block, *row_table(kinds, block == 0), illegal_pairs(roles), roles[0], roles[-1]

    return map_rows(blocks, run, TABLE)


def _families(tables: DataFrame, fanout: int) -> DataFrame:
    """The tables of neighbouring blocks in one row, in order."""
    member = F.struct(*(F.col(c) for c in tables.columns if c != "conv"))
    return tables.groupBy("conv", F.floor(F.col("block") / fanout).alias("block")).agg(
        F.array_sort(F.collect_list(member)).alias("children")
    )


def composed(tables: DataFrame, fanout: int) -> DataFrame:
    """One table for each ``fanout`` neighbouring ones."""
    def run(rows):
        for conv, block, children in rows:
            items = [table_edges(c["costs"], c["places"]) for c in children]
            between = sum(illegal_pairs(a["tail"] + b["head"]) for a, b in zip(children, children[1:]))
            illegal = sum(c["illegal"] for c in children) + between
            yield conv, block, *table(items, (START,) if block == 0 else range(4)), illegal, children[0]["head"], children[-1]["tail"]

    return map_rows(_families(tables, fanout), run, TABLE)


def traced(tables: DataFrame, chosen: DataFrame, fanout: int) -> DataFrame:
    """``conv, block, begin, to`` of the blocks, from those of their composed tables."""
    def run(rows):
        for conv, _, children, begin, to in rows:
            ways = child_states([(c["costs"], c["places"]) for c in children], begin, to)
            for child, (before, after) in zip(children, ways):
                yield conv, child["block"], before, after

    slim = tables.select("conv", "block", "costs", "places")
    return map_rows(_families(slim, fanout).join(chosen, ["conv", "block"]), run, "conv string, block long, begin int, to int")


def repair(rows: DataFrame, block: int = BLOCK, fanout: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The repaired turns, and per conversation its faults, cost and audit.

    ``rows`` has ``conv_id, turn, role, text, copies``. Repaired turns are ``conv, place, lead, role, text``: the row
    that stood at ``place``, with the roles of the empty turns inserted before it (``text`` null: only those).
    """
    said, marked = placed_rows(rows)
    texts = reliable_checkpoint(blocks_of(marked, block))
    levels = [reliable_checkpoint(tabled(texts))]
    while levels[-1].where("block > 0").take(1):
        levels.append(reliable_checkpoint(composed(levels[-1], fanout)))

    def finish(found):
        for conv, costs, order, illegal in found:
            last = ending(costs, order)
            yield conv, 0, START, last, costs[last] + COST["I"] * len(ENDINGS[last]), illegal, ENDINGS[last]

    whole = reliable_checkpoint(map_rows(
        levels[-1].select("conv", "costs", "places", "illegal"), finish,
        "conv string, block long, begin int, to int, cost long, illegal long, ending string",
    ))
    chosen = whole.select("conv", "block", "begin", "to")
    for tables in reversed(levels[:-1]):
        chosen = reliable_checkpoint(traced(tables, chosen, fanout))

    def edit(found):
        for conv, at, kinds, begin, to in found:
            audit = row_audit(kinds, begin, to)
            yield conv, at, audit, [(at * block + place, *rest) for place, *rest in row_edits(kinds, audit, begin)]

    edits = reliable_checkpoint(map_rows(
        texts.join(chosen, ["conv", "block"]), edit,
        "conv string, block long, audit string, edits array<struct<place: long, lead: string, role: string, kept: boolean>>",
    ))
    audits = edits.groupBy("conv").agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", "audit")))["audit"], "").alias("audit"))
    ends = F.concat("audit", F.repeat(F.lit("I"), F.length("ending")))
    summary = faults(marked).join(whole, "conv").join(audits, "conv").select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", ends.alias("audit")
    )
    changes = edits.select("conv", F.explode("edits").alias("edit")).select("conv", "edit.*")
    kept = changes.where("kept").join(marked.select("conv", F.col("first").alias("place"), "said_id"), ["conv", "place"])
    kept = kept.withColumnRenamed("role", "new_role").join(said.select("said_id", "role", "text"), "said_id")
    nothing = F.lit(None).cast("string")
    turns = kept.select("conv", "place", "lead", F.coalesce("new_role", "role").alias("role"), "text").unionByName(
        changes.where("not kept").select("conv", "place", "lead", nothing.alias("role"), nothing.alias("text"))
    ).unionByName(whole.where("ending <> ''").select(
        "conv", F.lit((1 << 63) - 1).alias("place"), F.col("ending").alias("lead"), nothing.alias("role"), nothing.alias("text")
    ))
    return turns, summary


def digests(turns: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: each conversation's lines, hashed one after the other."""
    added = F.transform(F.split("lead", ""), lambda r: F.when(r == "u", "user:").when(r == "a", "assistant:"))
    lines = F.array_compact(F.array_append(F.array_compact(added), F.concat("role", F.lit(":"), "text")))
    rows = turns.select("conv", "place", F.array_join(lines, "\n").alias("line"))

    def run(found):
        for conv, its in groupby(found, key=lambda r: r[0]):
            digest, between = hashlib.sha256(), b""
            for _, _, line in its:
                digest.update(between + line.encode())
                between = b"\n"
            yield conv, digest.hexdigest()

    return map_rows(rows.repartition("conv").sortWithinPartitions("conv", "place"), run, "conv string, repaired_sha256 string")


def audited(conversations: DataFrame) -> DataFrame:
    """Damage, repair and audit of every conversation of the table."""
    turns, summary = repair(damaged(conversations))
    every = conversations.select("conv_id", key_of(F.col("conv_id")).alias("conv")).distinct()
    found = every.join(summary, "conv", "left").join(digests(turns), "conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
