import math

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aeroledger.llm import queries, trie_counts
from tests.llm.helpers import MESSY, messy, table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return trie_counts.Pieces(PATH)


def slow_count(pieces, word):
    """Pieces of the best cut, by trying every cut of every prefix anew."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        if word[end - 1] not in pieces.score:
            size = len(word[end - 1].encode())
            options.append((best[end - 1][0] + size * pieces.byte_score, -(-best[end - 1][1] + size)))
        for start in range(end):
            own = pieces.score.get(word[start:end])
            if own is not None:
                options.append((best[start][0] + own, -(-best[start][1] + 1)))
        best.append(max(options))
    return -best[-1][1]


def slow_text(pieces, text):
    return sum(slow_count(pieces, "▁" + word) for word in (text or "").split())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aehintos▁é世\x00", min_size=1, max_size=14), max_size=30), st.sampled_from([5, 40, 10_000]))
def test_shared_prefixes_change_nothing(pieces, words, limit):
    trie = trie_counts.Trie(pieces, max_nodes=limit, max_known=7)
    trie.learn(set(words))
    for word in words:
        assert trie.known[word] == slow_count(pieces, word) == trie.insert(word)


def test_a_prefix_is_computed_once(pieces):
    trie = trie_counts.Trie(pieces)
    trie.learn({"▁interest", "▁interesting", "▁interests"})
    assert trie.nodes == 1 + len("▁interesting") + 1


def test_scores_are_log_probabilities(pieces):
    assert all(s < 0 for s in pieces.score.values())
    assert sum(math.exp(s) for s in pieces.score.values()) <= 1


def test_query_against_brute_force(spark, pieces):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    found = queries.op10_trie_counts(spark, "/root/testdata/sf0.001").collect()
    want = [(d, len(t), len(t.split()), slow_text(pieces, t)) for d, t in rows if len(t) < 3000]
    got = [tuple(r) for r in found if r["n_chars"] < 3000]
    assert len(found) == len(rows) and sorted(got) == sorted(want)


def test_messy_rows(spark, pieces):
    found = trie_counts.count_tokens(messy(spark), PATH)
    want = [(d, len(t or ""), len((t or "").split()), slow_text(pieces, t)) for d, t in MESSY]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)
    assert trie_counts.count_tokens(messy(spark).limit(0), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aehintos▁é世", min_size=1, max_size=60))
def test_the_window_gives_what_the_trie_gives(pieces, word):
    trie = trie_counts.Trie(pieces)
    assert trie.count_long(word) == trie.insert(word) and trie.known == {}


def test_long_pretokens_take_no_nodes(spark, pieces, monkeypatch):
    monkeypatch.setattr(trie_counts, "_TRIES", {})
    word = "internationalization" * 20_000 + "é世"
    trie = trie_counts.Trie(pieces, max_nodes=5_000)
    before = trie.nodes
    count = trie.count_long("▁" + word)
    assert trie.nodes == before and 20_000 < count < 200_000
    found = trie_counts.count_tokens(messy(spark, [(1, word), (2, f"two {word} {word}"), (3, "two")]), PATH).collect()
    by_id = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in found}
    assert by_id[1] == (1, count) and by_id[2] == (3, 2 * count + by_id[3][1])
