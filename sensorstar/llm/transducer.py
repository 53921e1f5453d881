"""Byte-level BPE as a finite-state transducer, and decoding as a stream.

The encoding of a beginning of a text is one row of tokens, and it ends the encoding
of the whole text where the next tokens stay apart from it. So after some bytes only
few rows can go on: one for each place from which the bytes read so far still begin a
token. A state of the transducer holds the last token of each of these rows and the
place of the bytes since in the tree of all tokens. Reading a byte moves every row on
and adds the row that ends here; its last token is what the move gives. Rows begin
less than a longest token back, so the tokens they share are certain and are written
after bounded lookahead. States and moves are made when first met and kept; when too
many are kept, all are forgotten and made anew.

Two tokens may stand side by side if the merges of their joined bytes give just these
two. The merges beside the border happen in the same order in any longer text, so a row
of tokens is the encoding if each is whole and all neighbours stay apart.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import by_batch

# Rows kept in all states together, pairs of tokens and bytes of words remembered before
# a task starts anew; only words of so many bytes are remembered. Speed depends on them,
# results do not.
KEPT_ROWS = 1_000_000
KEPT_PAIRS = 400_000
KEPT_BYTES = 4 << 20
LONGEST_KEPT = 64
# Tokens decoded at once.
STEP = 4096
NEVER = 1 << 60


def read_ranks(path: str) -> str:
    """The content of a file of tokens (base64) and ranks."""
    with open(path, encoding="ascii") as file:
        return file.read()


def ascii_form(pattern: str) -> str:
    """The pattern for texts of ASCII alone, without classes of Unicode."""
    found, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\.|\[|\])", pattern):
        if part in ("[", "]"):
            inside = part == "["
        elif part.startswith(r"\p"):
            signs = "A-Za-z" if part[3] == "L" else "0-9"
            part = signs if inside else f"[{signs}]"
        found.append(part)
    return "".join(found)


class Ranks:
    """Tokens as bytes, their ranks, and which of them stand apart."""

    def __init__(self, content: str) -> None:
        lines = (line.split() for line in content.splitlines() if line.strip())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {rank: token for token, rank in self.rank.items()}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.apart: dict[int, bool] = {}

    def merge(self, data: bytes, until: int = 1) -> list[bytes]:
        """The parts of ``data`` after merging the leftmost pair of least rank again
        and again, as long as there is one and more than ``until`` parts are left."""
        parts, rank = [data[n : n + 1] for n in range(len(data))], self.rank
        joined = [rank.get(parts[n] + parts[n + 1], NEVER) for n in range(len(parts) - 1)]
        while len(parts) > until and (least := min(joined, default=NEVER)) != NEVER:
            at = joined.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at < len(joined):
                joined[at] = rank.get(parts[at] + parts[at + 1], NEVER)
            if at:
                joined[at - 1] = rank.get(parts[at - 1] + parts[at], NEVER)
        return parts

    def is_whole(self, token: int) -> bool:
        return len(self.merge(self.bytes_of[token])) == 1

    def _edges(self, token: int) -> tuple[list, list] | None:
        """The pieces at the left and the right edge of a token as it grows, each with
        the rank of the merge that takes it up; None if ranks do not rise on the way, or
        the token is not whole."""
        if token not in self.edges:
            data = self.bytes_of[token]
            if len(data) == 1:
                found = ([(data, NEVER)], [(data, NEVER)])
            else:
                found = self._grown(token, data)
            self.edges[token] = found
        return self.edges[token]

    def _grown(self, token: int, data: bytes) -> tuple[list, list] | None:
        parts = self.merge(data, until=2)
        if len(parts) != 2 or any(p not in self.rank for p in parts):
            return None
        known = [self._edges(self.rank[p]) for p in parts]
        late = any(len(p) > 1 and self.rank[p] > token for p in parts)
        if late or None in known:
            return None
        left, right = known
        return (
            [*left[0][:-1], (parts[0], token), (data, NEVER)],
            [*right[1][:-1], (parts[1], token), (data, NEVER)],
        )

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the joined bytes of two whole tokens are encoded as these two."""
        key = left << 32 | right
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) >= KEPT_PAIRS:
                self.apart.clear()
            before, after = self._edges(left), self._edges(right)
            if before is None or after is None:
                joined = self.bytes_of[left] + self.bytes_of[right]
                found = [self.rank[p] for p in self.merge(joined)] == [left, right]
            else:
                found = self._no_merge_across(before[1], after[0])
            self.apart[key] = found
        return found

    def _no_merge_across(self, left: list, right: list) -> bool:
        """No merge across the border comes before the pieces beside it are taken up by
        their own tokens. Of equal ranks, the merge further left comes first."""
        a = b = 0
        while True:
            (piece, taken), (other, other_taken) = left[a], right[b]
            across = self.rank.get(piece + other, NEVER)
            if across < taken and across <= other_taken:
                return False
            if taken == NEVER and other_taken == NEVER:
                return True
            if taken <= other_taken:
                a += 1
            else:
                b += 1


class Transducer:
    """Bytes to tokens. State 0 has read nothing. A state is a row of numbers: the last
    token of each row of tokens that can go on, with the place in the tree of tokens of the
    bytes read since. Each move gives the token that ends with its byte."""

    def __init__(self, content: str) -> None:
        self.ranks = Ranks(content)
        self.length = {number: len(data) for number, data in self.ranks.bytes_of.items()}
        self.child: dict[int, int] = {}
        self.token, self.depth = [-1], [0]
        for data, number in self.ranks.rank.items():
            node = 0
            for byte in data:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.depth.append(self.depth[node] + 1)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node] = number
        self.inner = {key >> 8 for key in self.child}
        self.node_bits = len(self.token).bit_length()
        #: Stands for the last token where there is none.
        self.none = max(self.ranks.bytes_of, default=0) + 1
        self.whole: dict[int, bool] = {}
        #: Tokens are written every so many bytes: far more than any row that can go on covers.
        self.lookahead = 8 * max(self.length.values(), default=1)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        self.moves: dict[int, tuple[int, int]] = {}
        self.kept = 0
        self._numbered((self.none << self.node_bits,))

    def _numbered(self, state: tuple[int, ...]) -> int:
        found = self.number.get(state)
        if found is None:
            found = self.number[state] = len(self.states)
            self.states.append(state)
            self.kept += len(state)
        return found

    def _follows(self, last: int, token: int) -> bool:
        whole = self.whole.get(token)
        if whole is None:
            whole = self.whole[token] = self.ranks.is_whole(token)
        return whole and (last == self.none or self.ranks.stay_apart(last, token))

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """The state after one more byte, and the token that ends with it."""
        bits, child, inner = self.node_bits, self.child, self.inner
        low, ended, going = (1 << bits) - 1, -1, []
        for row in self.states[state]:
            node = child.get((row & low) << 8 | byte)
            if node is None:
                continue
            last = row >> bits
            if ended < 0 and (ends := self.token[node]) >= 0 and self._follows(last, ends):
                ended = ends
            if node in inner:
                going.append(last << bits | node)
        going.append(ended << bits)
        if self.kept >= KEPT_ROWS:
            self._forget()
            return self._numbered(tuple(going)), ended
        found = self.moves[state << 8 | byte] = self._numbered(tuple(going)), ended
        return found

    def encode(self, data: bytes) -> list[int]:
        """The tokens of ``data``, written as the bytes are read: what all rows that can
        go on share is certain."""
        moves, length = self.moves, self.length
        state, tokens, waiting = 0, [], []
        for start in range(0, len(data), self.lookahead):
            if start:
                self._write(state, waiting, tokens)
            for byte in data[start : start + self.lookahead]:
                found = moves.get(state << 8 | byte)
                if found is None:
                    found = self._move(state, byte)
                    moves = self.moves
                state, ended = found
                waiting.append(ended)
        rest, at = [], len(waiting)
        while at:
            rest.append(waiting[at - 1])
            at -= length[waiting[at - 1]]
        return tokens + rest[::-1]

    def _write(self, state: int, waiting: list[int], tokens: list[int]) -> None:
        """Take the tokens that all rows of ``state`` share from ``waiting``, where the
        token that ends with each byte stands, to ``tokens``."""
        low = (1 << self.node_bits) - 1
        common: set[int] | None = None
        for row in self.states[state]:
            at = len(waiting) - self.depth[row & low]
            cuts = {at}
            while at:
                at -= self.length[waiting[at - 1]]
                cuts.add(at)
            common = cuts if common is None else common & cuts
        at = last = max(common)
        found = []
        while at:
            found.append(waiting[at - 1])
            at -= self.length[waiting[at - 1]]
        tokens += found[::-1]
        del waiting[:last]


# Bytes that follow the first byte of a sign, by that byte; 0 where none may.
_FOLLOWING = [1 if 0xC2 <= b <= 0xDF else 2 if 0xE0 <= b <= 0xEF else 3 if 0xF0 <= b <= 0xF4 else 0 for b in range(256)]
# The second byte is narrower after some first bytes.
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


class Utf8Stream:
    """Bytes in pieces, given back in whole signs: the bytes of a sign that is not
    complete are held until the next piece, whatever tokens they come from.

    The machine's state is the first byte of the open sign and how many of its bytes
    were read; bytes that cannot go on end it and are given back as they are.
    """

    def __init__(self) -> None:
        self.held = b""

    def _open(self, data: bytes) -> int:
        """Bytes at the end of ``data`` that begin a sign and do not end it."""
        for back in range(1, min(3, len(data)) + 1):
            first = data[-back]
            if 0x80 <= first <= 0xBF:
                continue
            if _FOLLOWING[first] < back:
                return 0
            low, high = _SECOND.get(first, (0x80, 0xBF))
            return back if back == 1 or low <= data[1 - back] <= high else 0
        return 0

    def feed(self, data: bytes) -> bytes:
        data = self.held + data
        open_bytes = self._open(data)
        self.held = data[len(data) - open_bytes :]
        return data[: len(data) - open_bytes]

    def end(self) -> bytes:
        """What is left: an open sign that nothing completed."""
        left, self.held = self.held, b""
        return left


class ByteCodec:
    """Texts to tokens, each match of a pattern by itself, and back."""

    def __init__(self, content: str, pattern: str) -> None:
        self.transducer = Transducer(content)
        self.bytes_of, self.rank = self.transducer.ranks.bytes_of, self.transducer.ranks.rank
        self.pattern = regex.compile(pattern)
        self.ascii_pattern = re.compile(ascii_form(pattern), re.ASCII)
        self.known: dict[str, tuple[str, bytes]] = {}
        self.kept = 0

    def _word(self, word: str) -> tuple[str, bytes]:
        """Tokens of one match, as decimal text and packed. A match that is a token
        itself is that token, whatever its merges give."""
        data = word.encode()
        number = self.rank.get(data)
        tokens = [number] if number is not None else self.transducer.encode(data)
        found = ",".join(map(str, tokens)), array("I", tokens).tobytes()
        if len(data) <= LONGEST_KEPT:
            if self.kept >= KEPT_BYTES:
                self.known.clear()
                self.kept = 0
            self.known[word] = found
            self.kept += len(data)
        return found

    def encode(self, text: str) -> tuple[str, np.ndarray]:
        """Identifiers as decimal text joined by commas, and as numbers."""
        pattern = self.ascii_pattern if text.isascii() else self.pattern
        known, word = self.known, self._word
        words = [known.get(piece) or word(piece) for piece in pattern.findall(text)]
        return ",".join([w[0] for w in words]), np.frombuffer(b"".join([w[1] for w in words]), np.uint32)

    def decode(self, numbers: Iterable[int]) -> Iterator[bytes]:
        """The bytes of tokens in pieces that end with whole signs."""
        stream, numbers, bytes_of = Utf8Stream(), list(numbers), self.bytes_of
        for start in range(0, len(numbers), STEP):
            yield stream.feed(b"".join([bytes_of[n] for n in numbers[start : start + STEP]]))
        yield stream.end()

    def decode_text(self, numbers: Iterable[int]) -> str:
        """The same as text; bytes that are no UTF-8 become U+FFFD."""
        return "".join(piece.decode("utf-8", errors="replace") for piece in self.decode(numbers))


_CONTENT: dict[str, tuple[str, str]] = {}


@lru_cache(maxsize=1)
def _codec(key: str) -> ByteCodec:
    return ByteCodec(*_CONTENT[key])


def shared_codec(content: str, pattern: str) -> ByteCodec:
    """One codec for all tasks that a worker runs in turn, with the states it made."""
    key = hashlib.sha256(f"{pattern}\n{content}".encode()).hexdigest()
    _CONTENT.clear()
    _CONTENT[key] = content, pattern
    return _codec(key)


def byte_round_trip(documents: DataFrame, content: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)`` per row of ``documents``:
    the tokens of the whole text, a digest of their decimal numbers joined by commas, and
    one of the bytes they decode to. ``content`` is a file of tokens and ranks, ``pattern``
    cuts a text into the parts that are encoded by themselves.

    Null and empty texts have no tokens and decode to nothing. Ids may be null or repeat:
    each row is encoded by itself. An empty table gives an empty one. Other columns are
    not read. Without ``with_ids``, ``ids`` is left out. A long text without any cut is
    one run of the transducer: memory grows with its tokens only.
    """
    sent = documents.sparkSession.sparkContext.broadcast((content, pattern))

    def make():
        codec = shared_codec(*sent.value)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, digests, decoded, ids = [], [], [], []
            for text in batch.column("text").to_pylist():
                shown, numbers = codec.encode(text or "")
                counts.append(len(numbers))
                digests.append(hashlib.sha256(shown.encode()).hexdigest())
                whole = hashlib.sha256()
                for piece in codec.decode(numbers.tolist()):
                    whole.update(piece)
                decoded.append(whole.hexdigest())
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
