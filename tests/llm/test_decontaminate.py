import hashlib
import re

import pytest
from pyspark.sql import functions as F

from aeroledger.llm import decontaminate, queries
from tests.llm.helpers import messy, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(documents, items, size=10):
    held = []
    for item, text in items:
        w = words(text)
        held += [(item, tuple(w[i : i + size])) for i in range(max(1, len(w) - size + 1)) if w]
    by_length = {}
    for item, window in held:
        by_length.setdefault(len(window), {}).setdefault(window, set()).add(item)
    out = []
    for doc, text in documents:
        w, hit, found = words(text), set(), set()
        for length, known in by_length.items():
            for i in range(len(w) - length + 1):
                if (own := known.get(tuple(w[i : i + length]))) is not None:
                    hit |= set(range(i, i + length))
                    found |= {str(item) for item in own if item is not None}
        listed = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


PASSAGE = " ".join(f"w{i}" for i in range(25))
ITEMS = [
    (10, PASSAGE), (2, "Two Words"), (3, "single"), (4, None), (5, "..."), (6, "same same same same same same same same same same same"),
    (2, "Two Words"), (None, "only hit never named"), (33, "é à ü"), (7, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"),
]
DOCS = [
    (1, f"before {PASSAGE.upper()} after"), (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (3, PASSAGE[:-4]), (4, "two, words! TWO-words"),
    (5, "single"), (6, None), (7, ""), (8, "same " * 40), (9, "only hit never named"), (10, "É à ü é à ü"), (None, "single two words"),
    (1, f"before {PASSAGE.upper()} after"), (11, " ".join([PASSAGE] * 400)), (12, "sin gle"), (13, "w8 w9 w10 w11 w12 w13 w14"),
]


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("shingle", [1, 2, 3])
def test_against_brute_force(spark, shingle):
    docs = messy(spark, DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("words", F.lit(0))
    assert got(decontaminate.contamination(docs, items, shingle_words=shingle)) == slow(DOCS, ITEMS)




def test_joins_beyond_the_broadcast_size(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "sized_broadcast", lambda side: side)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(decontaminate.contamination(messy(spark, DOCS), items)) == slow(DOCS, ITEMS)


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, "benchmark").collect()]
    assert got(queries.op4_decontaminate(spark, "/root/testdata/sf0.001")) == slow(docs, items)


def test_filter_keeps_the_rest(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = messy(spark, DOCS)
    kept = decontaminate.without_contaminated(docs, items)
    clean = [d for d, row in zip(DOCS, [slow([d], ITEMS)[0] for d in DOCS]) if not row[-1]]
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_no_python_on_the_main_path(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontaminate.contamination(messy(spark, DOCS), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = messy(spark, DOCS)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    rows = decontaminate.contamination(docs, items.limit(0)).collect()
    assert len(rows) == len(DOCS) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in rows)
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == len(DOCS)
