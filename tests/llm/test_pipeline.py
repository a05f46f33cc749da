import hashlib

import corpus_pipeline
from tests.llm.helpers import messy, table
from tests.llm.test_decontaminate import slow
from tests.llm.test_simhash import slow_components, slow_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality ranking", "near-duplicates", "decontamination", "byte-level BPE"]
    docs = table(spark, "documents")
    columns = docs.columns
    kept = corpus_pipeline.good_documents(spark, docs, FOLDER)
    assert kept.columns == columns
    first = {r["doc_id"]: r["text"] for r in kept.collect()}
    label = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}
    clean = [d for d, q in label.items() if q == 1]
    junk = [d for d, q in label.items() if q == 0]
    assert sum(d in first for d in clean) >= 0.95 * len(clean) and sum(d not in first for d in junk) >= 0.7 * len(junk)

    single = corpus_pipeline.one_of_each_group(spark, kept, FOLDER)
    prints = {d: slow_fingerprint(t) for d, t in first.items()}
    group = slow_components(prints.values())
    lowest = {}
    for d in sorted(prints, reverse=True):
        lowest[group[prints[d]]] = d
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(lowest.values())

    left = corpus_pipeline.without_benchmark(spark, single, FOLDER)
    items = [(r["item_id"], r["text"]) for r in table(spark, "benchmark").collect()]
    want = [r[0] for r in slow([(d, first[d]) for d in lowest.values()], items) if not r[-1]]
    assert left.columns == columns and sorted(r["doc_id"] for r in left.collect()) == sorted(want)

    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert sorted(last) == sorted(want)
    assert all(r["decoded_sha256"] == hashlib.sha256(first[d].encode()).hexdigest() for d, r in last.items())


def test_messy_rows_pass_every_stage(spark):
    docs = messy(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 3
    empty = messy(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
