"""Word-by-word ids against the library's encoding of whole texts."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import tokens

PIECES = [
    "don't", "'ll", "'S", "a'll", "x'", "''", "12.5%", "<|endoftext|>", "a<|startoftext|>b", "|",
    "<|", "endoftext|>", "Σ", "ΑΣ", "İ", "ﬁ", "ǅ", "é", "́", "‍", "\x85", "\xa0",
    "　", "日本", "ÀÉß", "ªº", "×÷", "ÿ", "$$$", "!!", "...", "_", "`", "\0", "\x1c", "a,b", "Z.",
]
SPACES = [" ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c", ""]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)),
                          st.sampled_from(SPACES)), max_size=12))
def test_any_text(tokenizer, parts):
    text = "".join(piece + space for piece, space in parts)
    text = text.encode("utf-8", "ignore").decode()
    ids, bounds = tokens.encoder(tokens.vocabulary_path()).encode(pa.array([text, None, "a"]))
    expected = tokenizer.encode(text, add_special_tokens=False).ids + [tokens.END_ID]
    assert ids[: bounds[1]].tolist() == expected
    assert ids[bounds[1] : bounds[2]].tolist() == [tokens.END_ID]


def test_a_full_memory_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    encoder = tokens.Encoder(tokens.vocabulary_path())
    for text in ("one two three four", "five one six", "one two, seven!! One"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist()[:-1] == tokenizer.encode(text, add_special_tokens=False).ids
