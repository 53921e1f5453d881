"""Secrets in texts: all rules in one automaton, one pass over the bytes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.automaton import Automaton
from sensorstar.llm.common import by_batch, rows_by_batch


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``fold``: its letters stand for both cases. ``least``: bytes
    the span needs; with ``assigned``, the value after the sign needs them."""

    kind: str
    pattern: str
    fold: bool = False
    least: int = 1
    assigned: bool = False


# The kinds of secrets and their patterns.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        fold=True,
        least=6,
        assigned=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24}", least=24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36}"),
)
RULES = BASE + MORE


class _Accepting:
    """Stands for a state in which rules end. It has no successors of its own, so the
    scan stops there by itself instead of asking after every byte."""

    __slots__ = ("row", "rules")

    def __init__(self, row: list, rules: tuple[int, ...]) -> None:
        self.row, self.rules = row, rules


class Scanner:
    """Spans of all rules, as leftmost matches that do not overlap within a rule.

    The automaton tells where a match has ended; while the same match goes on, its
    end moves. The start is found by the rule's automaton read backwards, never
    before the end of the rule's last match. Spans too short for their rule are
    dropped at the end: they still use up their bytes.
    """

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        patterns = [(rule.pattern, rule.fold) for rule in rules]
        joined = Automaton(patterns)
        rows: list[list] = [[] for _ in joined.successors]
        nodes = [_Accepting(row, tuple(sorted(a))) if a else row for row, a in zip(rows, joined.accepts, strict=True)]
        for row, successors in zip(rows, joined.successors, strict=True):
            row.extend(nodes[s] for s in successors)
        self.states = len(rows)
        self.start = rows[joined.start]
        self.alone = [Automaton([p]) for p in patterns]
        self.back = [Automaton([p], anywhere=False, backwards=True) for p in patterns]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, end, rule number)`` in bytes, sorted."""
        total = len(data)
        found: list[list[list[int]]] = [[] for _ in self.rules]
        waits = [0] * len(self.rules)
        stream = iter(data)
        node = self.start
        while True:
            try:
                for byte in stream:
                    node = node[byte]
            except TypeError:
                self._ended(data, total - stream.__length_hint__() - 1, node.rules, found, waits)
                node = node.row[byte]
                continue
            if isinstance(node, _Accepting):
                self._ended(data, total, node.rules, found, waits)
            break
        kept = [
            (start, end, number)
            for number, spans in enumerate(found)
            for start, end in spans
            if self._long_enough(self.rules[number], data[start:end])
        ]
        return sorted(kept, key=lambda s: (s[0], s[2]))

    def _ended(self, data: bytes, end: int, rules: tuple[int, ...], found: list, waits: list[int]) -> None:
        for rule in rules:
            if end < waits[rule]:
                continue
            spans = found[rule]
            if spans and spans[-1][1] == end - 1:
                spans[-1][1] = end
                continue
            floor = spans[-1][1] if spans else 0
            start = self._begin(data, end, self.back[rule], floor)
            if start is None:
                waits[rule] = self._next_end(data, floor, self.alone[rule])
                if waits[rule] == end:
                    raise AssertionError("a match was not found backwards")
            else:
                spans.append([start, end])

    @staticmethod
    def _begin(data: bytes, end: int, back: Automaton, floor: int) -> int | None:
        state, start = back.start, None
        for at in range(end - 1, floor - 1, -1):
            state = back.successors[state][data[at]]
            if back.accepts[state]:
                start = at
            elif state == back.dead:
                break
        return start

    @staticmethod
    def _next_end(data: bytes, floor: int, alone: Automaton) -> int:
        """Where the rule ends next when it reads from ``floor`` on."""
        state = alone.start
        for at in range(floor, len(data)):
            state = alone.successors[state][data[at]]
            if alone.accepts[state]:
                return at + 1
        return len(data) + 1

    @staticmethod
    def _long_enough(rule: Rule, span: bytes) -> bool:
        if rule.assigned:
            sign = min(at for at in (span.find(b":"), span.find(b"=")) if at >= 0)
            span = span[sign + 1 :].lstrip(b" ")
            span = span[1:] if span[:1] in (b"'", b'"') else span
        return len(span) >= rule.least


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """One scanner per worker process: building it takes a moment."""
    return Scanner(rules)


def text_spans(text: str, scan: Scanner) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points."""
    data = text.encode()
    spans = scan.spans(data)
    if len(data) != len(text) and spans:
        ends = sorted({at for start, end, _ in spans for at in (start, end)})
        places, chars, before = {}, 0, 0
        for at in ends:
            chars += len(data[before:at].decode(errors="replace"))
            places[at] = chars
            before = at
        spans = [(places[start], places[end], rule) for start, end, rule in spans]
    return [(start, end, scan.rules[rule].kind) for start, end, rule in spans]


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each stretch that spans cover replaced by its first kind."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, spans, masked)`` per row of ``documents``: spans as an array of
    ``(start, end, kind)`` in code points, and the text with them masked.

    Null texts have no spans and a null masked text; ids may be null or repeat, each
    row is scanned by itself, whole, whatever its length. Other columns are not read.
    """

    def make():
        scan = scanner(rules)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            spans = [text_spans(t or "", scan) for t in texts]
            hidden = [t if not s else masked(t, s) for t, s in zip(texts, spans, strict=True)]
            rows = [[dict(zip(("start", "end", "kind"), s, strict=True)) for s in found] for found in spans]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, kind), pa.array(hidden, pa.string())], ["doc_id", "spans", "masked"]
            )

        return run

    source = documents.select("doc_id", F.col("text").cast("string"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return by_batch(source, make, f"doc_id {id_type}, spans array<struct<start:bigint,end:bigint,kind:string>>, masked string")


def mask_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``documents``, with secrets masked in ``text`` and
    ``n_chars`` (if there is one) counted anew where the text has changed."""

    def make():
        scan = scanner(rules)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns, names = list(batch.columns), batch.schema.names
            place = names.index("text")
            texts = columns[place].to_pylist()
            spans = [text_spans(t or "", scan) for t in texts]
            hidden = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            columns[place] = pa.array(hidden, columns[place].type)
            if "n_chars" in names:
                at = names.index("n_chars")
                sizes = [len(t) if s else n for t, s, n in zip(hidden, spans, columns[at].to_pylist(), strict=True)]
                columns[at] = pa.array(sizes, columns[at].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return run

    return rows_by_batch(documents, make)


def span_digests(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and all spans as one text."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*[rule.kind for rule in BASE])
    counts = [F.size(of(rule.kind)).cast("long").alias(f"n_{rule.kind}") for rule in BASE]
    return scanned.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
