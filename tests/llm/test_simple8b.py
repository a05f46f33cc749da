import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aeroledger.llm import queries, simple8b
from aeroledger.session import run_dir
from tests.llm.helpers import MESSY, messy, table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def blocks_back(ids, block):
    words, offsets = simple8b.pack(ids, block)
    sizes = np.array([len(ids[a : a + block]) for a in range(0, len(ids), block)], dtype=np.int64)
    assert len(offsets) == len(sizes)
    return simple8b.unpack(words, offsets.astype(np.int64), sizes)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 300), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=300),
       st.sampled_from([1, 7, 64, 4096]))
def test_ids_of_any_width(values, block):
    ids = np.array(values, dtype="<u8")
    assert blocks_back(ids, block).tolist() == values


def test_words_are_filled():
    assert len(simple8b.pack(np.ones(120, dtype="<u8"))[0]) == 2
    assert len(simple8b.pack(np.full(30, 49_000, dtype="<u8"))[0]) == 10
    assert len(simple8b.pack(np.array([1 << 63], dtype="<u8"))[0]) == 2
    assert simple8b.pack(np.ones(130, dtype="<u8"), 64)[1].tolist() == [0, 2, 4]


def test_file_holds_documents_and_ids():
    ids = np.arange(10_000, dtype="<u8") * 37 % 49_408
    docs, counts, back = simple8b.file_content(simple8b.file_bytes([3, 9], [4000, 6000], ids))
    assert docs.tolist() == [3, 9] and counts.tolist() == [4000, 6000] and (back == ids).all()


SPELLINGS = [
    "Don't you'll WE'RE 's 'S x's", "ΣΑΣ ΟΔΟΣ", "İstanbul ǅ K", "été ñ", "a\x1cb\x85c d", "12a3b ²½ Ⅷ", "word' 'word' it's!",
    "́start", "世界。hello", "a.b.c...", "<|endoftext|>x", "", " ", "\x00", "ﬁ ẞ",
]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abSTé'́ .!\n\x1c1²Σ世"), st.characters(codec="utf-8", exclude_categories=["Cn", "Co"])), max_size=30))
def test_ids_of_any_text(library, text):
    check_ids(library, text)


@pytest.mark.parametrize("text", SPELLINGS)
def test_ids_of_odd_spellings(library, text):
    check_ids(library, text)


def check_ids(library, text):
    if "<|" in text:
        library.encode_special_tokens = True
    ids = simple8b.cache_for(PATH).__getitem__
    got = np.frombuffer(b"".join(map(ids, simple8b.stretches(text))), "<u2").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


def expected(rows, library):
    library.encode_special_tokens = True
    out, ahead = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((doc, ahead, len(ids), zlib.crc32(ids.tobytes())))
        ahead += len(ids)
    return sorted(out, key=repr)


def test_query_against_the_library(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    found = queries.op6_simple8b(spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows, library)


@pytest.mark.parametrize("rows,size", [(4096, 1 << 20), (3, 5)])
def test_messy_rows(spark, library, rows, size):
    folder = run_dir(spark, "ids")
    manifest = simple8b.write_documents(messy(spark), PATH, folder, rows_per_range=rows, file_ids=size)
    found = sorted(simple8b.read_ids(manifest, folder).collect(), key=lambda r: r["start"])
    want = {}
    for doc, text in MESSY:
        want.setdefault(doc, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in MESSY), key=lambda d: (d is None, d or 0))
    ahead = 0
    for row in found:
        assert row["start"] == ahead
        ahead += row["n_tokens"]
        want[row["doc_id"]].remove(np.frombuffer(row["ids"], "<u4").tolist())
    assert not any(want.values())


def test_same_files_for_any_partitioning(spark):
    listed = []
    for parts in (1, 6):
        folder = run_dir(spark, "ids")
        manifest = simple8b.write_documents(messy(spark).repartition(parts), PATH, folder, rows_per_range=4, file_ids=50)
        listed.append(sorted((r["name"], r["sha256"]) for r in manifest.collect()))
    assert listed[0] == listed[1] and len(listed[0]) > 2


def test_damaged_file_is_reported(spark):
    folder = run_dir(spark, "ids")
    manifest = simple8b.write_documents(messy(spark), PATH, folder)
    name = f"{folder.removeprefix('file:')}/{manifest.first()['name']}"
    data = bytearray(open(name, "rb").read())
    data[-1] ^= 1
    with open(name, "wb") as out:
        out.write(data)
    with pytest.raises(Exception, match="does not match its manifest"):
        simple8b.read_ids(manifest, folder).collect()


def test_empty_table(spark):
    folder = run_dir(spark, "ids")
    manifest = simple8b.write_documents(messy(spark).limit(0), PATH, folder)
    assert manifest.count() == 0 and simple8b.read_ids(manifest, folder).count() == 0
