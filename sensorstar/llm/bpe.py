"""Byte-pair encoding: counting by a heap, exact encoding by backtracking, decoding.

Tokenizer files are read on the driver and sent to executors as one broadcast text;
their size is that of the vocabulary and has nothing to do with the documents.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import by_batch
from sensorstar.llm.transducer import ascii_form

# Signs of words whose result a task remembers before it starts anew, and of the longest
# word remembered: texts without spaces fill no memory.
REMEMBERED = 1_800_000
LONGEST_REMEMBERED = 64
# Pairs of tokens whose compatibility a task remembers before it starts anew.
REMEMBERED_PAIRS = 400_000
NEVER = 1 << 60


class Remembered(dict):
    """Results by word, made when first asked for."""

    def __init__(self, make: Callable) -> None:
        super().__init__()
        self.make, self.signs = make, 0

    def __missing__(self, word: str):
        found = self.make(word)
        if len(word) <= LONGEST_REMEMBERED:
            if self.signs >= REMEMBERED:
                self.clear()
                self.signs = 0
            self[word] = found
            self.signs += len(word)
        return found


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself where it is printable
    Latin-1, else the next sign from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(0x100 + others.index(b)) for b in range(256)]


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class Merges:
    """Symbols, ranked merges and special strings of a tokenizer file."""

    def __init__(self, text: str) -> None:
        content = json.loads(text)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            joined = self.ids[left + right]
            self.merge[self.ids[left], self.ids[right]] = (rank, joined)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        strings = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, strings)) + ")").split if strings else lambda t: [t]


def bytes_symbols(word: str, merges: Merges, signs: list[str]) -> list[int]:
    """The symbols a word starts with: one per byte, the last one with the word end."""
    found = [signs[b] for b in word.encode()]
    found[-1] += merges.suffix
    return [merges.ids[s] for s in found]


def merge_count(symbols: list[int], merge: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges byte-pair encoding makes. Symbols stand in a linked list;
    the heap gives the pair with the lowest rank, the leftmost of equal ones. An
    entry whose symbols have changed is passed over."""
    n = len(symbols)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols = list(symbols)
    heap = [(found[0], at, symbols[at], symbols[at + 1]) for at in range(n - 1) if (found := merge.get((symbols[at], symbols[at + 1])))]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, at, left, right = heapq.heappop(heap)
        other = following[at]
        if symbols[at] != left or other >= n or symbols[other] != right:
            continue
        symbols[at] = merge[left, right][1]
        symbols[other] = -1
        merges += 1
        after = following[at] = following[other]
        if after < n:
            before[after] = at
            if found := merge.get((symbols[at], symbols[after])):
                heapq.heappush(heap, (found[0], at, symbols[at], symbols[after]))
        if before[at] >= 0:
            earlier = before[at]
            if found := merge.get((symbols[earlier], symbols[at])):
                heapq.heappush(heap, (found[0], earlier, symbols[earlier], symbols[at]))
    return merges


# How the word tokenizer cuts a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")


def words_of(text: str) -> list[str]:
    """Words of a text in canonical composition and lower case, sign by sign: a
    final sigma is not told apart."""
    if text.isascii():
        return ASCII_WORDS.findall(text.lower())
    return WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


class TokenCounter:
    """Tokens of texts, without making them."""

    def __init__(self, tokenizer: str) -> None:
        self.merges, self.signs = Merges(tokenizer), byte_signs()
        self.known = Remembered(self.of_word)

    def of_word(self, word: str) -> int:
        symbols = bytes_symbols(word, self.merges, self.signs)
        return len(symbols) - merge_count(symbols, self.merges.merge)

    def of_text(self, text: str) -> int:
        pieces = self.merges.split_special(text)
        return len(pieces) // 2 + sum(sum(map(self.known.__getitem__, words_of(piece))) for piece in pieces[::2])


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``documents``; the
    tokenizer is the content of its file.

    Null and empty texts have no bytes and no tokens. Ids may be null or repeat;
    texts are counted whole, whatever their length. Other columns are not read.
    Signs that a Unicode version newer than the library's has added may be classed
    otherwise than by the library.
    """
    sent = documents.sparkSession.sparkContext.broadcast(tokenizer)

    def make():
        counter = TokenCounter(sent.value)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [counter.of_text(t) if t else 0 for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

        return run

    text = F.col("text").cast("string")
    source = documents.select("doc_id", text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    counted = by_batch(source, make, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


class Codec:
    """Byte-level encoding without searching for merges, and decoding.

    The longest token at each place comes from an Aho-Corasick automaton. Tokens are
    tried from long to short; a token may follow another if the two are compatible:
    byte-pair encoding of their joined bytes gives just these two. The first row of
    tokens in which all neighbours are compatible is the encoding. Places from which
    no row leads to the end are marked, so each is left at most once.
    """

    def __init__(self, tokenizer: str, pattern: str) -> None:
        merges = Merges(tokenizer)
        byte_of = {sign: byte for byte, sign in enumerate(byte_signs())}
        self.split_special, self.special = merges.split_special, merges.special
        self.pattern, self.ascii_pattern = regex.compile(pattern), re.compile(ascii_form(pattern), re.ASCII)
        size = max([*merges.ids.values(), *merges.special.values()]) + 1
        contents = [b""] * size
        for sign, number in merges.ids.items():
            if sign not in merges.special:
                contents[number] = bytes(byte_of[c] for c in sign)
        number_of = {content: number for number, content in enumerate(contents) if content}
        for sign, number in merges.special.items():
            contents[number] = sign.encode()
        self.length = [len(c) for c in contents]
        self.blob = np.frombuffer(b"".join(contents), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum(self.length))).astype(np.int64)
        self.merge = merges.merge
        self.parts: dict[int, tuple[int, int, int]] = {}
        for (left, right), (rank, joined) in merges.merge.items():
            if joined not in self.parts or rank < self.parts[joined][2]:
                self.parts[joined] = (left, right, rank)
        self.bytes_of, self.number_of = contents, number_of
        self.matcher = ahocorasick.Automaton()
        for content, number in number_of.items():
            self.matcher.add_word(content.decode("latin-1"), (len(content), number))
        self.matcher.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int | None] = {}
        self.whole: dict[int, bool] = {}
        self.known = Remembered(self._word)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The pieces at one edge of a token as it grows, each with the rank of the
        merge that takes it up."""
        edge, rank = [(token, NEVER)], NEVER
        while token in self.parts:
            left, last, rank = self.parts[token]
            token = last if right else left
            edge.append((token, rank))
        return edge[::-1]

    def compatible(self, left: int, right: int) -> bool:
        """No merge across the border comes before the pieces beside it are taken up
        by their own tokens. Of equal ranks, the merge further left comes first."""
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self._stay_apart(self._edge(left, True), self._edge(right, False))
        return found

    def _stay_apart(self, left: list, right: list) -> bool:
        a = b = 0
        while True:
            (piece, taken), (other, other_taken) = left[a], right[b]
            across = self.merge.get((piece, other), (NEVER, 0))[0]
            if across < taken and across <= other_taken and across != NEVER:
                return False
            if taken == NEVER and other_taken == NEVER:
                return True
            if taken <= other_taken:
                a += 1
            else:
                b += 1

    def is_whole(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as the token."""
        found = self.whole.get(token)
        if found is None:
            left = self.parts.get(token)
            found = self.whole[token] = self.length[token] == 1 or (
                left is not None and self.is_whole(left[0]) and self.is_whole(left[1]) and self._joins(left)
            )
        return found

    def _joins(self, parts: tuple[int, int, int]) -> bool:
        """The two parts stay whole until the merge that joins them."""
        left, right = self._edge(parts[0], True), self._edge(parts[1], False)
        left[-1], right[-1] = (left[-1][0], parts[2]), (right[-1][0], parts[2])
        a = b = 0
        while a < len(left) - 1 or b < len(right) - 1:
            (piece, taken), (other, other_taken) = left[a], right[b]
            across = self.merge.get((piece, other), (NEVER, 0))[0]
            if across < taken and across <= other_taken:
                return False
            if taken <= other_taken and a < len(left) - 1:
                a += 1
            else:
                b += 1
        return True

    def _next_shorter(self, token: int) -> int | None:
        """The longest token that is a true beginning of ``token``."""
        if token not in self.shorter:
            content = self.bytes_of[token]
            self.shorter[token] = next(
                (n for end in range(len(content) - 1, 0, -1) if (n := self.number_of.get(content[:end])) is not None), None
            )
        return self.shorter[token]

    def _longest(self, text: str, at: int) -> int | None:
        """The longest token at one place; only places that a row of tokens reaches are asked."""
        last, (length, number) = next(self.matcher.iter_long(text, at), (0, (0, None)))
        return number if last - length + 1 == at else None

    def encode_word(self, data: bytes) -> list[int]:
        total, text = len(data), data.decode("latin-1")
        tokens: list[int] = []
        dead = bytearray(total + 1)
        at, token = 0, self._longest(text, 0)
        while True:
            if token is None:
                dead[at] = 1
                token = tokens.pop()
                at -= self.length[token]
                token = self._next_shorter(token)
                continue
            end = at + self.length[token]
            if not dead[end] and self.is_whole(token) and (not tokens or self.compatible(tokens[-1], token)):
                tokens.append(token)
                at = end
                if at == total:
                    return tokens
                token = self._longest(text, at)
            else:
                token = self._next_shorter(token)

    def _word(self, word: str) -> str:
        return ",".join(map(str, self.encode_word(word.encode())))

    def encode(self, text: str) -> tuple[str, np.ndarray]:
        """Identifiers as decimal text joined by commas, and as numbers."""
        words: list[str] = []
        for place, piece in enumerate(self.split_special(text)):
            if place % 2:
                words.append(str(self.special[piece]))
            else:
                pattern = self.ascii_pattern if piece.isascii() else self.pattern
                words += map(self.known.__getitem__, pattern.findall(piece))
        shown = ",".join(words)
        return shown, np.fromstring(shown, np.uint32, sep=",")

    def decode(self, numbers: np.ndarray) -> str:
        """Texts of tokens, looked up by their offsets in the joined vocabulary."""
        starts = self.offsets[numbers]
        lengths = self.offsets[numbers + np.uint32(1)] - starts
        ends = np.cumsum(lengths)
        shift = np.repeat(starts - (ends - lengths), lengths)
        return self.blob[shift + np.arange(len(shift))].tobytes().decode("utf-8", errors="replace")


def encode_decode(documents: DataFrame, tokenizer: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)`` per row of ``documents``:
    the tokens of the whole text, and digests of them and of the text they decode to.

    Null and empty texts have no tokens and decode to an empty text. Ids may be null
    or repeat. Other columns are not read. Without ``with_ids``, ``ids`` is left out.
    """
    sent = documents.sparkSession.sparkContext.broadcast((tokenizer, pattern))

    def make():
        coder = Codec(*sent.value)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, digests, decoded, ids = [], [], [], []
            for text in batch.column("text").to_pylist():
                shown, numbers = coder.encode(text or "")
                counts.append(len(numbers))
                digests.append(hashlib.sha256(shown.encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(numbers).encode()).hexdigest())
                ids.append(numbers if with_ids else None)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            return pa.RecordBatch.from_arrays(columns, names)

        return run

    source = documents.select("doc_id", F.col("text").cast("string"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_batch(source, make, schema + (", ids array<int>" if with_ids else ""))
