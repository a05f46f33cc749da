"""Added tokens within texts, against the library as it is read from its file."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aeroledger.llm import simple8b
from aeroledger.session import run_dir
from tests.llm.helpers import messy

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "hello <|endoftext|> world", "a<|startoftext|>b", "<|endoftext|>", "<|EndOfText|> <|endoftext|", "x<|endoftext|><|endoftext|>",
    "<|startoftext|>Don't<|endoftext|>'s e<|endoftext|>́", "<|<|endoftext|>|>", "no added token",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(text):
    return np.frombuffer(b"".join(simple8b.cache_for(PATH).pieces(text)), "<u2").tolist()


@pytest.mark.parametrize("text", TEXTS)
def test_added_tokens(library, text):
    assert ids_of(text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "Don't", "é", "é", "\n", "12"]), max_size=12))
def test_added_tokens_anywhere(library, parts):
    assert ids_of("".join(parts)) == library.encode("".join(parts), add_special_tokens=False).ids


def test_documents_with_added_tokens(spark, library):
    folder, rows = run_dir(spark, "ids"), list(enumerate(TEXTS))
    found = simple8b.read_ids(simple8b.write_documents(messy(spark, rows), PATH, folder), folder).orderBy("doc_id").collect()
    ahead = 0
    for row, text in zip(found, TEXTS, strict=True):
        want = [*library.encode(text, add_special_tokens=False).ids, simple8b.END_ID]
        assert (row["start"], row["n_tokens"]) == (ahead, len(want))
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        ahead += len(want)
