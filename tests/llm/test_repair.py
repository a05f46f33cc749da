import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from aeroledger.llm import repair

BLANKS = " \t\n\x0b\x0c\r"
EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
AFTER = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        yield from [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)


def inserted(best):
    best = dict(best)
    for _ in range(4):
        for state, (cost, audit, lines) in list(best.items()):
            for role in ("user", "assistant"):
                after = AFTER.get((state, role[0]))
                option = (cost + 3, audit + "I", (*lines, role + ":"))
                if after and (after not in best or option[:2] < best[after][:2]):
                    best[after] = option
    return best


def cheapest(rows):
    """All edit lists as plain strings, least cost and then least string per state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for *_, role, text in rows:
        blank, again = not text.strip(BLANKS), (role, text) in seen
        seen.add((role, text))
        faults.append("blank" if blank else "again" if again else "" if text.rstrip(BLANKS)[-1] in ".!?" else "open")
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = {"0": (0, "", ())}
    for (*_, role, text), fault in zip(rows, faults):
        found = {}
        for state, (cost, audit, lines) in inserted(best).items():
            options = [(state, cost + 4, audit + "D", lines)]
            if fault in ("", "open"):
                more = 3 * (fault == "open")
                for edit, name, price in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if (state, name[:1]) in AFTER:
                        options.append((AFTER[state, name[:1]], cost + more + price, audit + edit, (*lines, f"{name}:{text}")))
            for after, *option in options:
                if after not in found or option[:2] < list(found[after][:2]):
                    found[after] = tuple(option)
        best = found
    cost, audit, lines = min((v for k, v in inserted(best).items() if k in "0a"), key=lambda v: v[:2])
    count = faults.count
    return gaps, count("blank"), count("again"), count("open"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def slow(rows):
    by = {r[0]: [] for r in rows}
    for row in damage(rows):
        by[row[0]].append(row)
    return sorted(repr((conv, *(cheapest(said) if said else EMPTY))) for conv, said in by.items())


def made(count, convs, seed=3):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "usher", ""]
    texts = ["a.", "b?", "c", "", "  ", "hello world.", "x! ", "y\n", None, "long. " * 5]
    return [
        (
            None if convs > 3 and n % convs == 3 else n % convs, rng.choice([None, *range(-3, 30)]) if n % 9 == 0 else n // convs,
            rng.choice(roles), rng.choice(texts),
        )
        for n in range(count)
    ]


def frame(spark, rows):
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return data.withColumns({c: F.lit("clash") for c in ("conv", "block", "place", "copies", "first", "digest")})


@pytest.mark.parametrize("rows", [made(600, 40), made(60, 60), []], ids=["many", "short", "empty"])
def test_against_all_edit_lists(spark, rows):
    assert sorted(map(repr, map(tuple, repair.audited(frame(spark, rows)).collect()))) == slow(rows)


@pytest.mark.parametrize("block, fanout", [(7, 2), (1, 3)])
def test_conversations_longer_than_a_block(spark, block, fanout, monkeypatch):
    rows = made(700, 3)
    monkeypatch.setattr(repair.repair, "__defaults__", (block, fanout))
    assert sorted(map(repr, map(tuple, repair.audited(frame(spark, rows)).collect()))) == slow(rows)


def test_a_conversation_of_one_repeated_row(spark):
    rows = [(1, 4, "user", "hi.")] * 400 + [(1, 5, "assistant", "yes.")]
    assert sorted(map(repr, map(tuple, repair.audited(frame(spark, rows)).collect()))) == slow(rows)


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "世界. \n" * 50_000)]
    assert sorted(map(repr, map(tuple, repair.audited(frame(spark, rows)).collect()))) == slow(rows)


def test_lists_compare_like_strings():
    rng = random.Random(5)
    edits, held = repair.Edits(), [(0, "")]
    for _ in range(400):
        node, text = rng.choice(held)
        more = "".join(rng.choice("DIKR") for _ in range(rng.choice((1, 1, 2, 9))))
        held.append((edits.extended(node, map(ord, more)), text + more))
    for _ in range(4000):
        (a, x), (b, y) = rng.choice(held), rng.choice(held)
        assert edits.less(a, b) == (x < y)
        assert "".join(map(chr, edits.listed(a))) == x


def test_hash_collisions_are_found(monkeypatch):
    monkeypatch.setattr(repair, "MODULUS", 3)
    test_lists_compare_like_strings()


def test_messy_conversation_ids(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (7, 1, "assistant", "b."), (7, 1, "assistant", "b.")]
    assert sorted(map(repr, map(tuple, repair.audited(frame(spark, rows)).collect()))) == slow(rows)
