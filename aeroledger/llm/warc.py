"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id into shards whose bounds depend on the ids alone.
A task walks its shard in order, regenerates every header and digest from the content,
writes one gzip member per record and starts a new file when the compressed size passes
a bound. Files are written under temporary names; a manifest names the ones that count
(``common.publish``). The same rows give the same files, byte for byte, whatever the
partitioning, order or retries.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest
page id is ``response``; the others are ``revisit`` records that refer to it and have no
block. The digest groups travel as narrow rows beside the pages, so payloads are shuffled
once and copies meet in no task.

Cases: a null html is an empty payload; a null url leaves the target header out; control
characters in a url are percent-encoded; rows that repeat a page id each have a record,
and of rows that repeat id and payload the first is the one that the others refer to; a
null page id comes last, is never referred to while its payload has a page with an id,
and is a response if it has none. An empty table gives no file. Further columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_REVISIT_BYTES = 100
ROWS_PER_SHARD = 4096
FILE_BYTES = 4 << 20
# No capture time is known, so the same input always gives the same bytes.
RECORD_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_CHUNK = 1 << 20


def record_id(page_id: int | None, url: str | None, digest: str, repeat: int) -> str:
    seed = hashlib.sha256(f"{page_id}\n{url}\n{digest}\n{repeat}".encode()).hexdigest()
    return f"<urn:uuid:{uuid.UUID(seed[:32])}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, repeat: int) -> bytes:
    """Bytes of one record; ``refers_to`` makes it a revisit without block."""
    block = payload if refers_to is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, url, digest, repeat)}",
        f"WARC-Date: {RECORD_DATE}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    lines += [
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class ShardFiles:
    """Files of one shard, rolled by compressed size, under temporary names."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.files, self.root = common.open_folder(folder)
        self.shard, self.limit, self.seq, self.out = shard, file_bytes, 0, None

    def add(self, data: bytes) -> Iterator[tuple]:
        member = gzip.compress(data, 6, mtime=0)
        if self.out and self.size and self.size + len(member) > self.limit:
            yield from self.close()
        if not self.out:
            self.staged = common.staged_name()
            self.files.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.files.open_output_stream(f"{self.root}/{self.staged}")
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> Iterator[tuple]:
        if self.out:
            self.out.close()
            self.out = None
            name = f"part-{self.shard:06d}-{self.seq:06d}.warc.gz"
            self.seq += 1
            yield (name, self.staged, self.shard, self.seq - 1, self.records, self.records, self.size,
                   self.digest.hexdigest())


def write_archives(
    pages: DataFrame, folder: str, rows_per_shard: int = ROWS_PER_SHARD, file_bytes: int = FILE_BYTES,
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Write ``page_id, url, html`` rows below ``folder``; the manifest."""
    payload = common.text_bytes("html")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    ranges = common.find_ranges(pages, "page_id", rows_per_shard)

    long_enough = rows.where(F.octet_length("payload") >= min_bytes).select("page_id", "digest")
    groups = long_enough.groupBy("digest").agg(F.count("*").alias("members"), F.min("page_id").alias("first_id"))
    groups = groups.where("members > 1 and first_id is not null").select("digest", "first_id")
    marks = long_enough.distinct().join(groups, "digest").select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "first_id"
    )
    both = marks.unionByName(rows.withColumn("first_id", F.lit(None).cast("long")))
    placed = ranges.number(both, "page_id", common.hex_place(F.col("digest")))
    dealt = common.in_ranges(placed, ranges).sortWithinPartitions(
        "range_no", F.col("page_id").asc_nulls_last(), "digest", F.col("payload").isNotNull(), "url"
    )

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        out, mark, shard, last, repeat = None, None, None, None, 0
        for shard, page_id, url, payload, digest, first_id in rows:
            if payload is None:
                mark = (page_id, digest, first_id)
                continue
            if out is None or out.shard != shard:
                if out:
                    yield from out.close()
                out = ShardFiles(folder, shard, file_bytes)
            repeat = repeat + 1 if last == (page_id, digest) else 0
            last = (page_id, digest)
            first = mark[2] if mark and mark[:2] == last else None
            is_first = first is None or (first == page_id and not repeat)
            yield from out.add(record(page_id, url, payload, digest, None if is_first else first, repeat))
        if out:
            yield from out.close()

    staged = common.map_rows(
        dealt.select("range_no", "page_id", "url", "payload", "digest", "first_id"), run, common.MANIFEST
    )
    return common.publish(staged, folder)


def records_of(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of each record of an open, decompressed archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers['warc-record-id']} is cut short")
        yield headers, block


READ_SCHEMA = (
    "page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, record_id string, file string"
)


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the files that the manifest names; digests are checked on the way.

    ``payload`` is the block: empty for a revisit, whose payload is that of the
    record it refers to.
    """
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        files, root = common.open_folder(folder)
        for (name,) in rows:
            with files.open_input_stream(f"{root}/{name}", compression=None) as raw:
                with io.BufferedReader(gzip.GzipFile(fileobj=raw), READ_CHUNK) as stream:
                    for headers, block in records_of(stream):
                        digest = headers["warc-payload-digest"].removeprefix("sha256:")
                        seen = hashlib.sha256(block).hexdigest()
                        kind, length = headers["warc-type"], int(headers["x-payload-length"])
                        if seen != headers["warc-block-digest"].removeprefix("sha256:") or (
                            kind == "response" and (seen, len(block)) != (digest, length)
                        ):
                            raise ValueError(f"{name}: {headers['warc-record-id']} does not match its digest")
                        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                        found = (
                            page and int(page), headers.get("warc-target-uri"), kind, refers and int(refers), length,
                            digest, headers["warc-record-id"], name,
                        )
                        yield (*found, block) if with_payload else found

    names = manifest.select("name").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "name")
    return common.map_rows(names, run, READ_SCHEMA + (", payload binary" if with_payload else ""))
