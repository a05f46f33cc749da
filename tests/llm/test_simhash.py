import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aeroledger.llm import common, queries, simhash
from tests.llm.helpers import MESSY, messy, table


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, bits=3):
    """Smallest reachable value of each value, by comparing all pairs."""
    values = sorted(set(values))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    mask = (1 << 64) - 1
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & mask).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {v: root(v) for v in values}


def slow_result(rows):
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    group = slow_components([f for _, f in prints])
    lowest = {}
    for i, f in prints:
        if i is not None:
            lowest[group[f]] = min(i, lowest.get(group[f], i))
    return Counter((i, f"{f:016x}", lowest.get(group[f])) for i, f in prints)


def clusters(seed, size):
    """Random centres with members some flips away, chains included."""
    rng = np.random.default_rng(seed)
    found = set()
    for centre in rng.integers(-(1 << 62), 1 << 62, size=12).tolist():
        at = centre
        for _ in range(size):
            at = (centre if rng.random() < 0.6 else at) & ((1 << 64) - 1)
            for bit in rng.integers(0, 64, size=rng.integers(0, 5)).tolist():
                at ^= 1 << bit
            found.add(simhash.signed(at))
    return sorted(found)


@pytest.mark.parametrize("bucket", [0, 6, 1000])
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_reach_what_all_pairs_reach(spark, bits, bucket):
    values = clusters(bits, 40)
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    found = common.components(simhash.links(distinct, bits, bucket))
    got = {r["node"]: r["label"] for r in found.collect()}
    want = slow_components(values, bits)
    assert {v: got.get(v, v) for v in values} == want


def test_every_close_pair_shares_a_block():
    rng = np.random.default_rng(5)
    masks = simhash.block_masks()
    for _ in range(500):
        flips = sum(1 << int(b) for b in rng.choice(64, size=3, replace=False))
        assert any(not flips & mask for mask in masks)
    assert min(m.bit_count() for m in masks) >= 30


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    found = queries.op2_simhash(spark, "/root/testdata/sf0.001")
    assert Counter(tuple(r) for r in found.select("doc_id", "fingerprint", "component_id").collect()) == slow_result(rows)


def test_messy_rows(spark):
    found = simhash.near_duplicates(messy(spark))
    shown = found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert Counter(tuple(r) for r in shown.collect()) == slow_result(MESSY)
    kept = simhash.one_per_group(messy(spark))
    assert kept.columns == messy(spark).columns
    group = slow_components([slow_fingerprint(t) for _, t in MESSY])
    assert kept.count() == len({group[slow_fingerprint(t)] for _, t in MESSY})
    first = {}
    for i, t in MESSY:
        g = group[slow_fingerprint(t)]
        first[g] = min(first.get(g, (True, 0)), (i is None, i or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(first.values())


def test_empty_table(spark):
    empty = messy(spark).limit(0)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_per_group(empty).count() == 0


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    got = {r["node"]: r["label"] for r in found.collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
