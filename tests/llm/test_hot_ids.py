"""A third of the rows without an id, and one id with many rows: files and results as with whole ranges."""

import hashlib

import public_tokenizers
import pytest

from aeroledger.llm import simple8b, warc, winnow
from aeroledger.session import run_dir

ROWS = [(None if n % 3 == 0 else 7 if n % 3 == 1 else n, f"Some words of text {n % 50} and more {n}.") for n in range(240)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_id_files(spark, documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = []
    for rows_per_range in (10_000, 20):
        target = run_dir(spark, "ids")
        manifest = simple8b.write_documents(documents, path, target, rows_per_range=rows_per_range)
        found.append(sorted((r["start"], repr(r["doc_id"]), r["n_tokens"], bytes(r["ids"])) for r in simple8b.read_ids(manifest, target).collect()))
        if rows_per_range == 20:
            assert manifest.select("range_no").distinct().count() > 10
    assert found[0] == found[1] and len(found[0]) == len(ROWS)


def test_archives(spark, documents):
    pages = documents.selectExpr("doc_id as page_id", "concat('http://x/', doc_id) as url", "repeat(text, 5) as html")
    found = []
    for rows_per_shard in (10_000, 20):
        target = run_dir(spark, "warc")
        manifest = warc.write_archives(pages, target, rows_per_shard)
        found.append(sorted(map(repr, warc.read_archives(manifest, target).drop("file").collect())))
    assert found[0] == found[1] and len(found[0]) == len(ROWS)


def test_next_documents(spark, documents):
    found = [sorted(map(repr, winnow.compare_with_next(documents, rows_per_range=n).collect())) for n in (10_000, 20)]
    assert found[0] == found[1] and len(found[0]) == len(ROWS)
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    want = sorted(
        hashlib.sha256(winnow.edited(text, order[(at + 1) % len(order)][1]).encode()).hexdigest() for at, (_, text) in enumerate(order)
    )
    assert sorted(r["edited_sha256"] for r in winnow.compare_with_next(documents, rows_per_range=20).collect()) == want
