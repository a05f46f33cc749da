import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aeroledger.llm import merkle

from .helpers import messy

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, at):
    for level in levels[:-1]:
        first = at - at % 3
        yield level[first:at], level[at + 1 : first + 3]
        at //= 3


def slow(rows):
    """Every tree and proof, one after the other."""
    sources = defaultdict(list)
    for row in rows:
        doc, text = row[0], row[4]
        tampered = doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0
        changed = leaf((*row[:4], text.replace("\n", ""))) if tampered else leaf(row)
        sources[row[1]].append((doc is not None, doc or 0, leaf(row), changed, doc))
    names = sorted(sources, key=lambda n: (n is not None, (n or "").encode()))
    trees = [levels_of([r[2] for r in sorted(sources[n])]) for n in names]
    top = levels_of([t[-1][0] for t in trees]) if trees else []
    out = []
    for place, (name, tree) in enumerate(zip(names, trees)):
        for at, (*_, own, fold, doc) in enumerate(sorted(sources[name])):
            met = [*way(tree, at), *way(top, place)]
            for left, right in met:
                fold = digest("".join(left) + fold + "".join(right))
            proof = digest("".join("".join(a + b) for a, b in met))
            out.append((doc, own, tree[-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(map(repr, out))


def made(count, sources):
    return [
        (
            None if n % 14 == 0 else n + n % 2, sources[n % len(sources)] if n % 5 else sources[0], None if n % 11 == 0 else "en",
            n, None if n % 13 == 0 else "a\nb" * (n % 4) + str(n % 9),
        )
        for n in range(count)
    ]


@pytest.mark.parametrize(
    "rows", [[], made(1, ["x"]), made(40, [None, "", "é", "z"]), made(2500, ["x", "y", None]), made(900, [f"s{n}" for n in range(800)])],
    ids=["empty", "one", "few", "two passes", "many sources"],
)
def test_proofs(spark, rows):
    found = merkle.proofs(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(repr, map(tuple, found.collect()))) == slow(rows)


def test_messy_rows(spark):
    rows = messy(spark).withColumns({c: F.lit("clash") for c in ("home", "idx", "hash", "tree", "level", "leaf")})
    plain = [tuple(r) for r in rows.select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).collect()]
    assert sorted(map(repr, map(tuple, merkle.proofs(rows).collect()))) == slow(plain)


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = [(1, "s", "en", 1, "a\n")] * 5
    found = merkle.proofs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, found))) == slow(rows) and len({r["proof_sha256"] for r in found}) > 1


def test_the_row_limit_of_the_session_is_restored(spark):
    before = spark.conf.get(merkle.ROW_LIMIT)
    merkle.proofs(spark.createDataFrame(made(4, ["x"]), SCHEMA)).count()
    assert spark.conf.get(merkle.ROW_LIMIT) == before
