"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that ends its encoding, so
an encoding is an array of last tokens. Token ``t`` ends the prefix of length ``i`` if it is
a suffix of it and the pair (last token before ``t``, ``t``) survives merging: encoding the
two tokens' bytes gives the two tokens back. Appending a byte adds one entry; after an edit
only entries from the edit on are computed again, and no further than where they agree with
the old ones for as many bytes as the longest token has.

``encode_documents`` splits whole texts, encodes each distinct piece once per worker within a
bounded memory, and decodes the ids again.

Cases: null text is empty and has no ids; bytes that are no UTF-8 are read as U+FFFD; rows with
equal ids each keep their row; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Pieces whose ids a worker keeps; a full cache starts anew.
CACHED_PIECES = 250_000
# Token pairs whose validity a worker keeps.
CACHED_PAIRS = 300_000
# Code points that are split at once; a longer text is cut between words.
SPLIT_CHARS = 1 << 20
# Code points of short texts whose pieces are encoded together.
BATCH_CHARS = 1 << 21


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PrefixEncoder:
    """Exact BPE of byte strings under a table of ranks that holds all single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: data for data, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        # Tokens that merging reaches from their own bytes; no others end a prefix.
        self.reached = {data: rank for data, rank in ranks.items() if len(data) == 1}
        for data, rank in ranks.items():
            parts = self.merge(data, rank)
            if len(parts) == 2:
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
                self.reached[data] = rank
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes, below: int) -> list[bytes]:
        """Parts left when every merge of a rank under ``below`` has been made, lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether the bytes of ``left`` then ``right`` are encoded as these two tokens.

        The merges of both are undone from the last to the first; equal merges happen
        from left to right. While two parts touch, their own merge must not come before
        the merge that makes one of them part of a larger token.
        """
        ranks, token, halves = self.ranks, self.token, self.halves
        until = 1 << 62
        while True:
            if ranks.get(token[left] + token[right], until) < until:
                return False
            first, second = halves.get(left), halves.get(right)
            if first is None and second is None:
                return True
            if second is None or (first is not None and left > right):
                until, left = left, first[1]
            else:
                until, right = right + 1, second[0]

    def extend(self, data: bytes, last: list[int], start: int, end: int) -> None:
        """Set ``last[start:end]``; the entries before ``start`` hold."""
        reached, pairs, longest = self.reached, self.pairs, self.longest
        for stop in range(start + 1, end + 1):
            for begin in range(max(0, stop - longest), stop):
                token = reached.get(data[begin:stop])
                if token is None:
                    continue
                if begin == 0:
                    break
                pair = (last[begin - 1], token)
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= CACHED_PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self.stays(*pair)
                if fits:
                    break
            last[stop - 1] = token

    def tokens(self, data: bytes, last: list[int]) -> list[int]:
        """Follow the last tokens back to the start."""
        found, stop = [], len(data)
        while stop:
            found.append(last[stop - 1])
            stop -= len(self.token[found[-1]])
        return found[::-1]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last = [0] * len(data)
        self.extend(data, last, 0, len(data))
        return self.tokens(data, last)


    def encode_sorted(self, pieces: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of pieces in byte order; each goes on from the prefix that it shares with the one before."""
        found, last, before = {}, [], b""
        for data in pieces:
            whole = self.ranks.get(data)
            if whole is not None:
                found[data] = [whole]
                continue
            shared = 0
            for a, b in zip(before, data):
                if a != b:
                    break
                shared += 1
            last[shared:] = [0] * (len(data) - shared)
            self.extend(data, last, shared, len(data))
            found[data] = self.tokens(data, last)
            before = data
        return found


class EditableBytes:
    """A byte string with the last token of every prefix, kept through appends and edits."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.last += [0] * len(more)
        self.encoder.extend(self.data, self.last, start, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace ``data[start:end]``; the number of prefixes that were computed again."""
        old = self.last[end:]
        self.data = self.data[:start] + new + self.data[end:]
        tail = start + len(new)
        self.last[start:] = [0] * (len(new) + len(old))
        self.encoder.extend(self.data, self.last, start, tail)
        same = at = 0
        # An entry depends on the entries and bytes of one longest token before it.
        while at < len(old) and same < self.encoder.longest:
            self.encoder.extend(self.data, self.last, tail + at, tail + at + 1)
            same = same + 1 if self.last[tail + at] == old[at] else 0
            at += 1
        self.last[tail + at :] = old[at:]
        return len(new) + at

    def ids(self) -> list[int]:
        return self.encoder.tokens(self.data, self.last)


# ---- splitting text into pieces -------------------------------------------------------

LETTER, NUMBER, SPACE = 1, 2, 3
#: The endings that the split pattern takes as pieces of their own.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


class PieceSplitter:
    """The matches of the rank files' split pattern, found with array operations.

    Whether a code point is a letter, a number or white space is asked of ``regex`` once.
    """

    def __init__(self):
        self.kind = np.zeros(0x110000, dtype=np.uint8)
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        for value, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for run in regex.finditer(pattern, every):
                points = np.frombuffer(run[0].encode("utf-32-le"), dtype="<u4")
                self.kind[points] = value

    def starts(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        kind, size = self.kind[points], len(points)
        change = np.empty(size, dtype=bool)
        change[0] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        blank = kind == SPACE
        start = change.copy()
        # A run of white space before something else leaves its last character to a piece of its own,
        # which takes in what follows if that character is a blank.
        after = np.flatnonzero(change[1:] & blank[:-1]) + 1
        start[after - 1] = True
        start[after] = points[after - 1] != 0x20
        marks = np.flatnonzero(start & (points == 0x27))
        marks = marks[marks + 1 < size]
        marks = marks[kind[marks + 1] == LETTER]
        for at in marks.tolist():
            ending = text[at + 1 : at + 3]
            length = 2 if ending[0] in SHORT_ENDINGS else 3 if ending in LONG_ENDINGS else 0
            if length:
                start[at + 1] = False
                if at + length < size:
                    start[at + length] = True
        return np.flatnonzero(start)

    def pieces(self, text: str) -> list[str]:
        if not text:
            return []
        starts = self.starts(text).tolist()
        return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


BETWEEN_WORDS = regex.compile(r"(?<=\S) (?=\S)")


def portions(text: str, size: int = SPLIT_CHARS) -> Iterator[str]:
    """Parts of a long text, cut where a piece starts whatever stands around it."""
    start = 0
    while len(text) - start > size:
        cut = BETWEEN_WORDS.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class TextEncoder:
    """Whole texts to ids and back; one per worker and vocabulary.

    ``known`` holds the ids of pieces as little-endian 32-bit words and starts anew when it is full.
    """

    def __init__(self, path: str, limit: int = CACHED_PIECES):
        self.encoder, self.splitter, self.limit = PrefixEncoder(read_ranks(path)), PieceSplitter(), limit
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        fresh = pieces.difference(self.known)
        if len(self.known) + len(fresh) > self.limit:
            self.known, fresh = {}, pieces
        found = self.encoder.encode_sorted(sorted(piece.encode() for piece in fresh))
        for data, ids in found.items():
            self.known[data.decode()] = struct.pack(f"<{len(ids)}I", *ids)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; new pieces of all texts are encoded together."""
        split = [self.splitter.pieces(text) for text in texts]
        self.learn(set().union(*split))
        ids = self.known.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in split]

    def encode(self, text: str) -> bytes:
        return b"".join(self.encode_all([part])[0] for part in portions(text))

    def decode(self, ids: bytes) -> bytes:
        return decoded(ids, self.encoder.token)


def decoded(ids: bytes, token: dict[int, bytes]) -> bytes:
    """The bytes of tokens given as little-endian 32-bit words."""
    return b"".join(map(token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder_for(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


_TOKENS: dict[str, dict[int, bytes]] = {}


def tokens_for(path: str) -> dict[int, bytes]:
    """Bytes of each id; all that a worker needs to decode."""
    if path not in _TOKENS:
        _TOKENS[path] = {rank: data for data, rank in read_ranks(path).items()}
    return _TOKENS[path]


# ---- whole tables --------------------------------------------------------------------------

def encode_documents(documents: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids`` per row; ``ids`` holds little-endian unsigned 32-bit integers."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = encoder_for(ranks_path)
        held, size = [], 0
        for doc_id, raw in rows:
            text = common.decode(raw)
            if len(text) > SPLIT_CHARS:
                yield doc_id, encoder.encode(text)
                continue
            held.append((doc_id, text))
            size += len(text)
            if size >= BATCH_CHARS:
                yield from zip((i for i, _ in held), encoder.encode_all([t for _, t in held]))
                held, size = [], 0
        yield from zip((i for i, _ in held), encoder.encode_all([t for _, t in held]))

    return common.map_rows(documents.select("doc_id", common.text_bytes("text").alias("raw")), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        token = tokens_for(ranks_path)
        for doc_id, ids in rows:
            yield doc_id, ids, decoded(ids, token)

    return common.map_rows(encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary")


def round_trip(documents: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text and its ids."""
    both = decode_documents(encode_documents(documents, ranks_path), ranks_path)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
