"""Token ids as files of Simple-8b words.

A 64-bit word holds a 4-bit selector and up to 60 ids of equal width; the selector says how
many ids of how many bits. An id that needs more than 60 bits is an escape: its own selector
word, then the raw id. Ids are cut into blocks that start at a word, and each file lists the
word at which every block starts, so blocks are decoded on their own and, within a file, all
words of one selector at once.

Documents go to files in ascending order of their id. Ranges of ids, and so the files, depend
on the ids alone; a file appears whole or not at all (``common.publish``).

File: magic, then unsigned 64-bit little-endian counts (documents, ids, block size, blocks,
words), then document ids (signed), ids per document, first word of each block, words.

Cases: added tokens of the tokenizer in a text (``<|endoftext|>``) have their own ids, as the library
gives them; null text is empty and yields the end id alone; rows with equal ids follow each other,
ordered by their text; null ids come last and are written as a missing id; bytes that are no
UTF-8 are read as U+FFFD; an empty table gives no file; further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

END_ID = 1
ROWS_PER_RANGE = 4096
FILE_IDS = 1 << 20
BLOCK_IDS = 1 << 12
MAGIC = b"S8BIDS01"
NO_ID = -(1 << 63)
# Spellings whose ids a worker keeps; a full cache starts anew.
CACHED = 700_000

#: Ids per word and bits per id of selectors 0 to 13, as Simple-8b defines them.
PACKS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15


# ---- words -------------------------------------------------------------------------

def fitting(narrow: np.ndarray, count: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a word of ``count`` narrow ids may start, and how many ids it takes.

    Runs of narrow ids end at a wide one and at a block's end; only at a block's end
    may a word be filled in part.
    """
    size = len(narrow)
    change = narrow[1:] != narrow[:-1]
    change[block - 1 :: block] = True
    start = np.concatenate([[0], np.flatnonzero(change) + 1])
    end = np.append(start[1:], size)
    closes = (end % block == 0) | (end == size)
    run = narrow[start] & ((end - start >= count) | closes)
    start, end, closes = start[run], end[run], closes[run]
    length = end - start
    place = np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)
    left = np.repeat(end, length) - place
    fits = (left >= count) | np.repeat(closes, length)
    return place[fits], np.minimum(left[fits], count)


def word_starts(taken: np.ndarray, block: int) -> np.ndarray:
    """Where words start, if a word at a place takes so many ids; all blocks are walked side by side."""
    size = len(taken)
    start = np.zeros(size, dtype=bool)
    at = np.arange(0, size, block)
    end = np.minimum(at + block, size)
    while len(at):
        start[at] = True
        at = at + taken[at]
        inside = at < end
        if not inside.all():
            at, end = at[inside], end[inside]
    return np.flatnonzero(start)


def pack(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Words of unsigned 64-bit ids, greedily the most ids per word, and each block's first word.

    No word holds ids of two blocks; the last word of a block may hold fewer than it has room for.
    """
    size = len(ids)
    if not size:
        return np.empty(0, dtype="<u8"), np.empty(0, dtype="<u8")
    # The narrowest selector that takes each id.
    need = np.zeros(size, dtype=np.int8)
    for _, bits in PACKS:
        need += ids >= np.uint64(1 << bits)
    choice = np.full(size, ESCAPE, dtype=np.int8)
    taken = np.ones(size, dtype=np.int64)
    # The selector that takes every id fits everywhere, so wider ones need no look.
    for selector in reversed(range(min(len(PACKS), int(need.max()) + 1))):
        place, count = fitting(need <= selector, PACKS[selector][0], block)
        choice[place] = selector
        taken[place] = count
    starts = word_starts(taken, block)
    chosen, held = choice[starts], taken[starts]
    width = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), dtype="<u8")
    words[place] = chosen.astype("<u8") << np.uint64(60)
    for selector, (count, bits) in enumerate(PACKS):
        of = np.flatnonzero(chosen == selector)
        if not len(of):
            continue
        first, target, room = starts[of], place[of], held[of]
        value = words[target]
        for k in range(count):
            inside = room > k
            if inside.all():
                value |= ids[first + k] << np.uint64(bits * k)
            else:
                value[inside] |= ids[first[inside] + k] << np.uint64(bits * k)
        words[target] = value
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[place[escaped] + 1] = ids[starts[escaped]]
    return words, place[starts % block == 0].astype("<u8")


def unpack(words: np.ndarray, first_word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ids of consecutive blocks; ``first_word`` and ``sizes`` are per block."""
    if not len(words):
        return np.empty(0, dtype="<u8")
    selector = (words >> np.uint64(60)).astype(np.int64)
    # A word after an escape is raw, and raw words may look like an escape themselves.
    header = np.ones(len(words), dtype=bool)
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if header[at]:
            header[at + 1] = False
    room = np.array([*(count for count, _ in PACKS), 0, 1])
    held = np.where(header, room[selector], 0)
    block = np.searchsorted(first_word, np.arange(len(words)), side="right") - 1
    before = np.cumsum(held) - held
    offset = before - before[first_word][block]
    start = np.cumsum(sizes) - sizes
    held = np.minimum(held, sizes[block] - offset)
    target = start[block] + offset
    ids = np.zeros(int(sizes.sum()), dtype="<u8")
    for which, (count, bits) in enumerate(PACKS):
        of = np.flatnonzero(header & (selector == which))
        mask = np.uint64((1 << bits) - 1)
        for k in range(count if len(of) else 0):
            own = of[held[of] > k]
            ids[target[own] + k] = (words[own] >> np.uint64(bits * k)) & mask
    escaped = np.flatnonzero(header & (selector == ESCAPE))
    ids[target[escaped]] = words[escaped + 1]
    return ids


def file_bytes(doc_ids: list[int], counts: list[int], ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    head = np.array([len(doc_ids), len(ids), BLOCK_IDS, len(offsets), len(words)], dtype="<u8")
    return b"".join([
        MAGIC, head.tobytes(), np.array(doc_ids, dtype="<i8").tobytes(), np.array(counts, dtype="<u8").tobytes(),
        offsets.tobytes(), words.tobytes(),
    ])


def file_content(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, ids per document, all ids of one file."""
    if data[:8] != MAGIC:
        raise ValueError("no Simple-8b file")
    docs, total, block, blocks, words = map(int, np.frombuffer(data, "<u8", 5, 8))
    at = 48
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    counts = np.frombuffer(data, "<u8", docs, at + 8 * docs).astype(np.int64)
    at += 16 * docs
    offsets = np.frombuffer(data, "<u8", blocks, at).astype(np.int64)
    body = np.frombuffer(data, "<u8", words, at + 8 * blocks)
    sizes = np.full(blocks, block)
    if blocks:
        sizes[-1] = total - block * (blocks - 1)
    return doc_ids, counts, unpack(body, offsets, sizes)


# ---- ids of texts ---------------------------------------------------------------------

def id_type(plan: dict) -> str:
    """16 bits per id where the vocabulary allows, else 32."""
    added = (token["id"] for token in plan["added_tokens"])
    return "<u2" if max([*plan["model"]["vocab"].values(), *added]) < 1 << 16 else "<u4"


def read_plan(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


class SpellingCache(dict):
    """Ids of each white-space-free stretch of text, asked of the library once per spelling.

    The tokenizer drops white space, and neither its normaliser nor its split pattern
    looks across it, so a text's ids are those of its stretches one after another. Added
    tokens are found in the raw text before all else and have ids of their own (``pieces``).
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        plan = read_plan(path)
        splits = [p["pattern"]["Regex"] for p in plan["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(splits[0])
        self.code = {"<u2": "H", "<u4": "I"}[id_type(plan)]
        self.words: dict[str, bytes] = {}
        if any(token["normalized"] or token["single_word"] for token in plan["added_tokens"]):
            raise ValueError("only added tokens that stand for themselves in the raw text are supported")
        self.added = {token["content"]: struct.pack(f"<{self.code}", token["id"]) for token in plan["added_tokens"]}
        # The longest of those that start at a place is found, as the library does it.
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})")
        # The library's model alone; stretches come to it normalised and split.
        plan |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(plan)).model
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        spare = iter(range(0x100, 0x200))
        self.spelled = {b: b if b in printable else next(spare) for b in range(256)}

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            # Printable ASCII stands for its own bytes.
            spelled = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.spelled)
            found = [token.id for token in self.model.tokenize(spelled)]
            ids = struct.pack(f"<{len(found)}{self.code}", *found)
            if len(self.words) >= CACHED:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = ids
        return ids

    def __missing__(self, stretch: str) -> bytes:
        if stretch.isascii():
            plain = stretch.lower()
            body = plain[:-1]
            if plain.isalpha():
                ids = self.word(plain)
            elif body.isalpha() and not plain[-1].isdigit():
                ids = self.word(body) + self.word(plain[-1])
            else:
                ids = b"".join(map(self.word, self.pattern.findall(plain)))
        else:
            # Rust lower-cases each code point by itself, without the rule for a final sigma.
            plain = unicodedata.normalize("NFC", stretch).replace("Σ", "σ").lower()
            ids = b"".join(map(self.word, self.pattern.findall(plain)))
        if len(self) >= CACHED:
            self.clear()
        if len(stretch) <= 64:
            self[stretch] = ids
        return ids


    def pieces(self, text: str) -> Iterator[bytes]:
        """Ids of a raw text in order, piece by piece."""
        if not any(token in text for token in self.added):
            yield from map(self.__getitem__, stretches(text))
            return
        for number, part in enumerate(self.cut.split(text)):
            if number % 2:
                yield self.added[part]
            else:
                yield from map(self.__getitem__, stretches(part))


# White space of Unicode; Python's split also takes the four separators that are none.
SEPARATORS = re.compile("[\x1c-\x1f]")
STRETCH = regex.compile(r"\S+")


def stretches(text: str) -> list[str]:
    return STRETCH.findall(text) if SEPARATORS.search(text) else text.split()


_CACHES: dict[str, SpellingCache] = {}


def cache_for(path: str) -> SpellingCache:
    if path not in _CACHES:
        _CACHES[path] = SpellingCache(path)
    return _CACHES[path]


def tokenize(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, text_key, ids`` per row, ``ids`` with the end id as integers of ``id_type``."""
    end = np.array([end_id], dtype=id_type(read_plan(tokenizer_path))).tobytes()

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        pieces = cache_for(tokenizer_path).pieces
        for doc_id, key, raw in rows:
            yield doc_id, key, b"".join(pieces(common.decode(raw))) + end

    raw = common.text_bytes("text")
    return common.map_rows(
        documents.select("doc_id", F.xxhash64(raw).alias("text_key"), raw.alias("raw")), run,
        "doc_id long, text_key long, ids binary",
    )


# ---- files --------------------------------------------------------------------------------

class IdFiles:
    """Files of one range; documents are never cut between files."""

    def __init__(self, folder: str, range_no: int, file_ids: int, kind: str):
        self.files, self.root = common.open_folder(folder)
        self.range_no, self.limit, self.seq = range_no, file_ids, 0
        self.kind = np.dtype(kind)
        self.reset()

    def reset(self) -> None:
        self.docs, self.counts, self.parts, self.total = [], [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        self.docs.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids) // self.kind.itemsize)
        self.parts.append(ids)
        self.total += self.counts[-1]
        if self.total >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.docs:
            data = file_bytes(self.docs, self.counts, np.frombuffer(b"".join(self.parts), dtype=self.kind).astype("<u8"))
            staged = common.staged_name()
            self.files.create_dir(f"{self.root}/_temporary", recursive=True)
            with self.files.open_output_stream(f"{self.root}/{staged}") as out:
                out.write(data)
            name = f"part-{self.range_no:06d}-{self.seq:06d}.s8b"
            yield (name, staged, self.range_no, self.seq, len(self.docs), self.total, len(data),
                   hashlib.sha256(data).hexdigest())
            self.seq += 1
            self.reset()


def write_ids(
    tokenized: DataFrame, ranges: common.Ranges, folder: str, file_ids: int = FILE_IDS, kind: str = "<u4"
) -> DataFrame:
    """Write ``doc_id, text_key, ids`` rows (ids of type ``kind``) below ``folder``; the manifest."""
    # The upper bits of the signed key, in its order.
    place = (F.shiftright("text_key", 33) + (1 << 30)).cast("double") / float(1 << 31)
    dealt = common.in_ranges(ranges.number(tokenized, "doc_id", place), ranges).sortWithinPartitions(
        "range_no", F.col("doc_id").asc_nulls_last(), "text_key"
    )

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        out = None
        for range_no, doc_id, ids in rows:
            if out is None or out.range_no != range_no:
                if out:
                    yield from out.close()
                out = IdFiles(folder, range_no, file_ids, kind)
            yield from out.add(doc_id, ids)
        if out:
            yield from out.close()

    return common.publish(common.map_rows(dealt.select("range_no", "doc_id", "ids"), run, common.MANIFEST), folder)


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of the manifest.

    ``start`` counts the ids of all documents before it. Ids are summed per range, of which there are few, on the
    driver, and over the files of a range in its own window.
    """
    spark = manifest.sparkSession
    sums = sorted((r["range_no"], r["items"]) for r in manifest.groupBy("range_no").agg(F.sum("items").alias("items")).collect())
    starts = list(zip((n for n, _ in sums), accumulate((items for _, items in sums), initial=0)))
    ranges = spark.createDataFrame(starts, "range_no int, ahead long")
    earlier = W.partitionBy("range_no").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    inside = manifest.withColumn("inside", F.coalesce(F.sum("items").over(earlier), F.lit(0)))
    # A row per range, at most ``MAX_RANGES`` of them.
    placed = inside.join(F.broadcast(ranges), "range_no").select("name", (F.col("ahead") + F.col("inside")).alias("first"), "sha256")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        store, root = common.open_folder(folder)
        for name, first, digest in rows:
            with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                data = stream.read()
            if hashlib.sha256(data).hexdigest() != digest:
                raise ValueError(f"{name} does not match its manifest")
            doc_ids, counts, ids = file_content(data)
            ids = ids.astype("<u4") if not len(ids) or ids.max() < 1 << 32 else ids
            ends = np.cumsum(counts)
            for doc_id, count, end in zip(doc_ids.tolist(), counts.tolist(), ends.tolist()):
                own = ids[end - count : end]
                yield (None if doc_id == NO_ID else doc_id), first + end - count, count, own.tobytes()

    names = placed.repartition(4 * spark.sparkContext.defaultParallelism, "name")
    return common.map_rows(names, run, "doc_id long, start long, n_tokens long, ids binary")


def write_documents(documents: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID,
                    rows_per_range: int = ROWS_PER_RANGE, file_ids: int = FILE_IDS) -> DataFrame:
    ranges = common.find_ranges(documents, "doc_id", rows_per_range)
    kind = id_type(read_plan(tokenizer_path))
    return write_ids(tokenize(documents, tokenizer_path, end_id), ranges, folder, file_ids, kind)


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
