"""The transducer and the byte stream against the library and plain versions."""

from __future__ import annotations

import base64
import codecs
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from sensorstar.llm import transducer

DOC = "doc_id long, text string, ids string, n_tokens string"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return transducer.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def codec(ranks):
    return transducer.ByteCodec(ranks, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.rank, special_tokens={})


def odd_texts(seed, count):
    rng = random.Random(seed)
    signs = [*"ab é日1²\n\tЖü", "́", "😀", "'s", "'LL", "\x00", " ", "  ", "<|endoftext|>", "==", "aaaa", "\x1c", "\x85"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(count)]
    spans = [(32, 0xD800), (0xE000, 0x11000), (0x10000, 0x110000)]
    texts += ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(40)) for _ in range(count // 10)]
    return texts


def test_as_the_library(codec, library):
    long = ["ab" * 30_000, "=" * 9_000, "日" * 5_000, "".join(random.Random(2).choices("abcdefghij", k=40_000))]
    for text in odd_texts(1, 3_000) + long:
        shown, numbers = codec.encode(text)
        expected = library.encode_ordinary(text)
        assert numbers.tolist() == expected and shown == ",".join(map(str, expected))
        assert codec.decode_text(expected) == text


def test_any_ranks():
    """Ranks without order: tokens that no merges give, and ranks that fall on the way."""
    rng = random.Random(3)
    for _ in range(40):
        tokens = [bytes([b]) for b in range(256)]
        tokens += list({bytes(rng.choices(b"abc", k=rng.randrange(2, 6))) for _ in range(rng.randrange(1, 25))})
        numbers = list(range(len(tokens)))
        rng.shuffle(numbers)
        table = dict(zip(tokens, numbers, strict=True))
        content = "".join(f"{base64.b64encode(t).decode()} {n}\n" for t, n in table.items())
        made = transducer.ByteCodec(content, PATTERN)
        library = tiktoken.Encoding("any", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        for _ in range(40):
            text = "".join(rng.choices("abc ", [5, 5, 5, 1], k=rng.randrange(200)))
            assert made.encode(text)[1].tolist() == library.encode_ordinary(text)


def test_states_are_forgotten_without_effect(ranks, library, monkeypatch):
    monkeypatch.setattr(transducer, "KEPT_ROWS", 50)
    monkeypatch.setattr(transducer, "KEPT_PAIRS", 20)
    monkeypatch.setattr(transducer, "KEPT_BYTES", 30)
    small = transducer.ByteCodec(ranks, PATTERN)
    for text in odd_texts(4, 200) + ["Straßenverkehrsordnung " * 50, "xyzzy" * 300]:
        assert small.encode(text)[1].tolist() == library.encode_ordinary(text)
    assert small.transducer.kept < 100


def test_tokens_are_written_while_reading(codec, library):
    """After every stretch only bytes that rows still going on may change are waiting."""
    data = "".join(random.Random(5).choices("abcdefghijklmnop", k=20_000)).encode()
    machine, waits = codec.transducer, []
    write = machine._write

    def watched(state, waiting, tokens):
        write(state, waiting, tokens)
        waits.append(len(waiting))

    machine._write = watched
    try:
        tokens = machine.encode(data)
    finally:
        del machine._write
    assert b"".join(machine.ranks.bytes_of[t] for t in tokens) == data
    assert len(waits) > 50 and max(waits) < machine.lookahead


@pytest.mark.parametrize("data", [
    "aé日😀".encode() * 3, b"\xff\xfe", b"\xe0\x80\x80", b"\xed\xa0\x80x", b"\xf0\x9f\x98", b"\xf4\x90\x80\x80", b"\xc0\xaf", b"\x80\x80\x80\x80", b"a\xe6\x97",
])
def test_stream_as_the_incremental_decoder(data):
    whole = data.decode("utf-8", errors="replace")
    for size in range(1, len(data) + 1):
        stream, library, texts = transducer.Utf8Stream(), codecs.getincrementaldecoder("utf-8")("replace"), []
        for start in range(0, len(data), size):
            texts.append(stream.feed(data[start : start + size]).decode("utf-8", errors="replace"))
            expected = library.decode(data[start : start + size])
            assert texts[-1] == expected or "\ufffd" in whole
        assert "".join(texts) + stream.end().decode("utf-8", errors="replace") == whole


def test_stream_holds_only_open_signs():
    stream, sign = transducer.Utf8Stream(), "😀".encode()
    assert [stream.feed(sign[n : n + 1]) for n in range(4)] == [b"", b"", b"", sign]
    assert stream.feed(b"a" + sign[:2]) == b"a" and stream.end() == sign[:2] and stream.end() == b""


def test_round_trip_of_rows(spark, ranks, library):
    texts = [None, "", " ", "the", "the", *odd_texts(6, 60), "word " * 20_000]
    ids = [None if n == 2 else 7 if n < 5 else n for n in range(len(texts))]
    rows = [(i, t, "clash", "clash") for i, t in zip(ids, texts, strict=True)]
    got = transducer.byte_round_trip(spark.createDataFrame(rows, DOC), ranks, PATTERN).collect()

    def expected(number, text):
        numbers = library.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
        return (number, len(numbers), digest, hashlib.sha256((text or "").encode()).hexdigest(), tuple(numbers))

    found = [(*r[:4], tuple(r["ids"])) for r in got]
    assert sorted(found, key=str) == sorted((expected(*row[:2]) for row in rows), key=str)


def test_empty_table(spark, ranks):
    got = transducer.byte_round_trip(spark.createDataFrame([], DOC), ranks, PATTERN, with_ids=False)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == 0


def test_long_words_are_not_kept(ranks):
    """100,000 different words of a kilobyte leave the caches small."""
    from sensorstar.llm import bpe

    made = bpe.Remembered(lambda word: word * 2)
    small = transducer.ByteCodec(ranks, PATTERN)
    for n in range(100_000):
        word = f"{n:06d}" * 170
        assert made[word] == word * 2
    for n in range(300):
        small.encode(f"{n:06d}" * 170)
    assert not made and not small.known
    for n in range(400_000):
        made[f"word{n}"]
    assert 0 < made.signs <= bpe.REMEMBERED + bpe.LONGEST_REMEMBERED
