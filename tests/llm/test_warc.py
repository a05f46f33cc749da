import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from aeroledger.llm import warc
from aeroledger.session import run_dir

COPY = "<p>copy</p>" * 20
PAGES = [
    (1, "http://a/1", COPY), (2, "http://a/2", COPY), (3, "http://a/3", "<p>short</p>"), (4, "http://a/4", "<p>short</p>"),
    (5, None, None), (6, "http://a/6", ""), (7, "http://a/ü x\r\nInjected: 1", "é" * 80), (None, "http://n/1", COPY),
    (None, "http://n/2", "z" * 200), (None, "http://n/3", "z" * 200), (8, "http://a/8", "WARC/1.1\r\n\r\n" * 30),
    (1, "http://a/1", COPY), (9, "http://a/9", "long " * 400_000),
]


def pages(spark, rows=PAGES):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.withColumn("digest", F.lit("clash")).withColumn("range_no", F.lit(3))


def wanted(rows):
    out, seen = [], set()
    known = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            known[html] = min(page, known.get(html, page))
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        first = known.get(html) if len(data) >= 100 else None
        response = first is None or (first == page and (page, html) not in seen)
        seen.add((page, html))
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if response else "revisit", None if response else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,size", [(4096, 4 << 20), (3, 300), (1, 1)])
def test_round_trip(spark, shard, size):
    folder = run_dir(spark, "warc")
    manifest = warc.write_archives(pages(spark), folder, rows_per_shard=shard, file_bytes=size)
    read = warc.read_archives(manifest, folder, with_payload=True)
    got = read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "target_uri").collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == wanted(PAGES)
    for row in got:
        if row["record_type"] == "response":
            assert hashlib.sha256(row["payload"]).hexdigest() == row["payload_digest"]
    assert {r["target_uri"] for r in got if r["page_id"] == 7} == {"http://a/%C3%BC%20x%0D%0AInjected:%201"}
    sizes = [r["bytes"] for r in manifest.collect()]
    assert all(b <= size or n == 1 for b, n in zip(sizes, [r["records"] for r in manifest.collect()]))


def test_same_bytes_for_any_partitioning(spark):
    folders = []
    for parts in (1, 7):
        folder = run_dir(spark, "warc")
        manifest = warc.write_archives(pages(spark).repartition(parts), folder, rows_per_shard=3, file_bytes=500)
        folders.append(sorted((r["name"], r["sha256"]) for r in manifest.collect()))
        root = folder.removeprefix("file:")
        names = [n for n in os.listdir(root) if n.endswith(".warc.gz")]
        assert sorted(names) == [n for n, _ in folders[-1]]
        assert not os.listdir(f"{root}/_temporary")
        with gzip.open(f"{root}/{names[0]}") as stream:
            assert stream.readline() == b"WARC/1.1\r\n"
    assert folders[0] == folders[1]


def test_damaged_archive_is_reported(spark):
    folder = run_dir(spark, "warc")
    manifest = warc.write_archives(pages(spark, PAGES[:4]), folder)
    name = f"{folder.removeprefix('file:')}/{manifest.first()['name']}"
    data = gzip.decompress(open(name, "rb").read()).replace(b"<p>short", b"<p>shirt")
    with open(name, "wb") as out:
        out.write(gzip.compress(data))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(manifest, folder).collect()


def test_empty_table(spark):
    folder = run_dir(spark, "warc")
    manifest = warc.write_archives(pages(spark).limit(0), folder)
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0
