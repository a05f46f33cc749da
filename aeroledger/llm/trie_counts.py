"""Token counts of a unigram tokenizer, computed once per shared prefix of the pre-tokens.

A unigram tokenizer cuts a pre-token into pieces with the greatest sum of scores. The best score
of a prefix does not depend on what follows, so pre-tokens go into a trie whose nodes keep it
with the number of pieces behind it: a new pre-token costs only the nodes that it does not share,
and its terminal node holds its count. Ties of the score go to fewer pieces.

The vocabulary file names the pieces in order of rank. Scores follow the rank by Zipf's rule,
``-log(rank + ZIPF_SHIFT)`` minus the log of the normaliser: nothing is trained here. A code point
that begins no piece falls back to its UTF-8 bytes, each at the score of the last rank.

Each worker keeps one trie of bounded size and inserts the distinct pre-tokens of a batch of rows;
a full trie starts anew, which costs time but changes nothing. A pre-token of more than ``MAX_WORD`` code
points shares little: the same recurrence runs over a window as long as the longest piece, without nodes, and
its count is not kept beyond the batch. No text leaves its row.

Cases: null or blank text has no token; rows with equal ids each keep their row; bytes that are
no UTF-8 are read as U+FFFD; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame

from . import common

ZIPF_SHIFT = 2.7
#: Fixed value: the mark of a word's start in the vocabulary.
WORD_START = "▁"
MAX_NODES = 1_500_000
MAX_KNOWN = 400_000
# Code points up to which a pre-token becomes nodes.
MAX_WORD = 1_024


class Pieces:
    """Scores of the pieces of a SentencePiece vocabulary file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        total = model.get_piece_size()
        shift = math.log(sum(1 / (rank + ZIPF_SHIFT) for rank in range(total)))
        self.score = {}
        for rank in range(total):
            if not (model.is_byte(rank) or model.is_control(rank) or model.is_unknown(rank) or model.is_unused(rank)):
                self.score[model.id_to_piece(rank)] = -math.log(rank + ZIPF_SHIFT) - shift
        self.byte_score = -math.log(total + ZIPF_SHIFT) - shift
        self.longest = max(map(len, self.score))


class Node:
    """A prefix: the best score of it, the pieces behind that score, the next characters."""

    __slots__ = ("score", "count", "next")

    def __init__(self, score: float, count: int):
        self.score, self.count, self.next = score, count, {}


class Trie:
    def __init__(self, pieces: Pieces, max_nodes: int = MAX_NODES, max_known: int = MAX_KNOWN):
        self.pieces, self.max_nodes, self.max_known = pieces, max_nodes, max_known
        self.known: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.root, self.nodes = Node(0.0, 0), 1

    def insert(self, word: str) -> int:
        """Pieces of the best cut of ``word``; only prefixes that are new are computed."""
        if self.nodes + len(word) > self.max_nodes and self.nodes > 1:
            self.clear()
        path, node = [self.root], self.root
        for end, char in enumerate(word, 1):
            child = node.next.get(char)
            if child is None:
                child = node.next[char] = self.grow(word, end, path)
                self.nodes += 1
            path.append(child)
            node = child
        return node.count

    def grow(self, word: str, end: int, path: list[Node]) -> Node:
        first = max(0, end - self.pieces.longest)
        return self.best(word, end, first, path[first:end])

    def best(self, word: str, end: int, first: int, ahead: list[Node]) -> Node:
        """The best cut of ``word[:end]``; ``ahead`` are the prefixes of ``first`` to ``end - 1`` code points."""
        score_of = self.pieces.score
        # One code point by its bytes is always possible.
        if word[end - 1] in score_of:
            best, count = -math.inf, 0
        else:
            size = len(word[end - 1].encode())
            best, count = ahead[-1].score + size * self.pieces.byte_score, ahead[-1].count + size
        for start in range(first, end):
            own = score_of.get(word[start:end])
            if own is not None:
                before = ahead[start - first]
                score = before.score + own
                if score > best or (score == best and before.count + 1 < count):
                    best, count = score, before.count + 1
        return Node(best, count)

    def count_long(self, word: str) -> int:
        """Pieces of the best cut of a long pre-token; only the last prefixes are held."""
        size = self.pieces.longest
        ring = [self.root] * (size + 1)
        for end in range(1, len(word) + 1):
            first = max(0, end - size)
            ring[end % (size + 1)] = self.best(word, end, first, [ring[at % (size + 1)] for at in range(first, end)])
        return ring[len(word) % (size + 1)].count

    def learn(self, words: set[str]) -> None:
        """Insert words in order, so that those that share a prefix come together."""
        fresh = sorted(words - self.known.keys())
        if len(self.known) + len(fresh) > self.max_known:
            self.known = {}
            fresh = sorted(words)
        self.known |= {word: self.insert(word) for word in fresh}


_TRIES: dict[str, Trie] = {}


def trie_for(path: str) -> Trie:
    if path not in _TRIES:
        _TRIES[path] = Trie(Pieces(path))
    return _TRIES[path]


# Code points of text whose pre-tokens are inserted together.
BATCH_CHARS = 1 << 21


def count_tokens(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, n_chars, n_pretokens, n_tokens`` of every whole text."""

    def flush(trie: Trie, held: list[tuple]) -> Iterator[tuple]:
        words = {word for _, _, words in held for word in words}
        long = {word for word in words if len(word) > MAX_WORD}
        trie.learn(words - long)
        # Each long pre-token once per batch.
        counts = {word: trie.count_long(word) for word in long}
        known = trie.known.__getitem__
        for doc_id, size, words in held:
            if counts:
                yield doc_id, size, len(words), sum(counts[w] if w in counts else known(w) for w in words)
            else:
                yield doc_id, size, len(words), sum(map(known, words))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        trie = trie_for(vocabulary_path)
        held, size = [], 0
        for doc_id, raw in rows:
            text = common.decode(raw)
            held.append((doc_id, len(text), [WORD_START + word for word in text.split()]))
            size += len(text)
            if size >= BATCH_CHARS:
                yield from flush(trie, held)
                held, size = [], 0
        yield from flush(trie, held)

    narrow = documents.select("doc_id", common.text_bytes("text").alias("raw"))
    return common.map_rows(narrow, run, "doc_id long, n_chars long, n_pretokens long, n_tokens long")
