import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from aeroledger.llm import common, prefix_bpe, queries
from tests.llm.helpers import LONG, MESSY, messy, table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXT = st.text(alphabet=st.one_of(st.sampled_from("abst'reveldm \n\t.!?1²é世\x1c\x85 ́"), st.characters(codec="utf-8")), max_size=40)


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.encoder_for(PATH)


@pytest.fixture(scope="module")
def library():
    ranks = prefix_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_pieces_and_ids_of_any_text(encoder, library, text):
    assert encoder.splitter.pieces(text) == regex.findall(public_tokenizers.PATTERN, text)
    ids = encoder.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def plain_merges(ranks, data):
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_every_prefix_has_its_last_token(encoder):
    data = " unbelievable Straßenbahnhaltestelle çëñ xxxxxxxxxx".encode()
    editable = prefix_bpe.EditableBytes(encoder.encoder, data)
    for stop in range(1, len(data) + 1):
        assert editable.last[stop - 1] == plain_merges(encoder.encoder.ranks, data[:stop])[-1]


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=12), st.integers(0, 60), st.integers(0, 20))
def test_edits_and_appends(encoder, data, new, start, length):
    start = min(start, len(data))
    end = min(len(data), start + length)
    editable = prefix_bpe.EditableBytes(encoder.encoder, data)
    editable.replace(start, end, new)
    edited = data[:start] + new + data[end:]
    assert editable.data == edited and editable.ids() == plain_merges(encoder.encoder.ranks, edited)
    editable.append(b" and more")
    assert editable.ids() == plain_merges(encoder.encoder.ranks, edited + b" and more")


def test_edit_stops_near_its_place(encoder):
    data = (" the quick brown fox" * 200).encode()
    editable = prefix_bpe.EditableBytes(encoder.encoder, data)
    assert editable.replace(100, 104, b"slow") < 200


def test_pieces_known_from_shared_prefixes(encoder, library):
    words = [" th" + a + b for a in ("at", "ation", "ationing", "e") for b in ("", "s", "ed", "!?", "é")]
    found = encoder.encoder.encode_sorted(sorted(w.encode() for w in words))
    for data, ids in found.items():
        assert ids == library.encode_ordinary(data.decode()) or not regex.fullmatch(public_tokenizers.PATTERN, data.decode())


def test_long_texts_are_cut_between_words(encoder, monkeypatch):
    text = LONG[:4000] + "\n\n  x  " + "y" * 500 + " end 's 're"
    whole = regex.findall(public_tokenizers.PATTERN, text)
    for size in (1, 7, 100, 5000):
        cut = [p for part in prefix_bpe.portions(text, size) for p in encoder.splitter.pieces(part)]
        assert cut == whole


def test_small_caches_change_nothing(library):
    small = prefix_bpe.TextEncoder(PATH, limit=3)
    assert np.frombuffer(small.encode(LONG[:3000]), "<u4").tolist() == library.encode_ordinary(LONG[:3000])


def expected(rows, library):
    out = []
    for doc, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), dtype="<u4")
        out.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_the_library(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    found = queries.op5_prefix_bpe(spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows, library)


def test_messy_rows(spark, library):
    found = prefix_bpe.round_trip(messy(spark), PATH)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(MESSY, library)
    assert prefix_bpe.round_trip(messy(spark).limit(0), PATH).count() == 0


def test_bytes_that_are_no_text():
    assert common.decode(b"a\xffb") == "a�b"
