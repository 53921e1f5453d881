"""The longest token at a place, asked only where a row of tokens arrives."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorstar.llm.bpe import Codec, read_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    return Codec(read_tokenizer(PATH), public_tokenizers.PATTERN)


@pytest.mark.parametrize("word", [" boqueco", "Ciónmenterr", "a" * 300, " " * 40, "=-" * 50, "漢字漢", "x1é\x00"])
def test_longest_token_at_every_place(codec, word):
    data = word.encode()
    for at in range(len(data)):
        wanted = next(n for end in range(len(data), at, -1) if (n := codec.number_of.get(data[at:end])) is not None)
        assert codec._longest(data.decode("latin-1"), at) == wanted


def test_places_inside_tokens_are_not_asked(codec):
    asked, longest = [], codec._longest
    codec._longest = lambda text, at: asked.append(at) or longest(text, at)
    try:
        found = codec.encode_word(b" the")
    finally:
        codec._longest = longest
    assert asked == [0] and found == Tokenizer.from_file(PATH).encode(" the", add_special_tokens=False).ids


def test_words_are_encoded_as_by_the_library(codec):
    library = Tokenizer.from_file(PATH)
    text = "Ciónmenterr boqueco  queie osdoque ñññ " + "a" * 500 + " 0123456789 " + "ab" * 200 + "漢字\n\n x"
    assert codec.encode(text)[1].tolist() == library.encode(text, add_special_tokens=False).ids
