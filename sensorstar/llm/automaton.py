"""Several regular expressions as one deterministic automaton over bytes.

Expressions become one automaton with free moves; subset construction makes it
deterministic and refinement of equal states makes it minimal. The result is one
array of 256 successors per state.

Expressions may use literals, ``\\xHH`` and ``\\.`` escapes, ``[...]`` classes, groups,
``|``, ``?``, ``*``, ``+`` and ``{n}``.
"""

from __future__ import annotations

from collections.abc import Iterable

ALL = frozenset(range(256))


class _Parts:
    """States with free moves and moves on sets of bytes."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def closure(self, states: Iterable[int]) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for target in self.free[todo.pop()]:
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return frozenset(seen)


class _Reader:
    """Reads one expression and adds it to the parts, forwards or backwards."""

    def __init__(self, text: str, fold: bool) -> None:
        self.text, self.fold, self.at = text, fold, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("or", options) if len(options) > 1 else options[0]

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated())
        return ("then", items)

    def repeated(self):
        item = self.single()
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            if sign == "{":
                count = ""
                while self.peek() != "}":
                    count += self.take()
                self.take()
                item = ("then", [item] * int(count))
            else:
                item = (sign, item)
        return item

    def single(self):
        sign = self.take()
        if sign == "(":
            inner = self.choice()
            self.take()
            return inner
        if sign == "[":
            return ("byte", self.members())
        return ("byte", self.folded({self.escaped() if sign == "\\" else ord(sign)}))

    def escaped(self) -> int:
        sign = self.take()
        return int(self.take() + self.take(), 16) if sign == "x" else ord(sign)

    def members(self) -> frozenset:
        found: set[int] = set()
        while (sign := self.take()) != "]":
            low = self.escaped() if sign == "\\" else ord(sign)
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                sign = self.take()
                found.update(range(low, (self.escaped() if sign == "\\" else ord(sign)) + 1))
            else:
                found.add(low)
        return self.folded(found)

    def folded(self, members: set[int]) -> frozenset:
        if self.fold:
            signs = [chr(m) for m in members if m < 128]
            members = members | {ord(f) for s in signs for f in (s.lower(), s.upper())}
        return frozenset(members)


def _build(parts: _Parts, tree, start: int, backwards: bool) -> int:
    """Add ``tree`` after ``start``; the state in which it ends."""
    kind, inside = tree
    if kind == "byte":
        end = parts.state()
        parts.moves[start].append((inside, end))
        return end
    if kind == "then":
        for item in reversed(inside) if backwards else inside:
            start = _build(parts, item, start, backwards)
        return start
    end = parts.state()
    if kind == "or":
        for option in inside:
            parts.free[_build(parts, option, start, backwards)].append(end)
        return end
    entry = parts.state()
    parts.free[start].append(entry)
    last = _build(parts, inside, entry, backwards)
    parts.free[last].append(end)
    if kind in "*+":
        parts.free[last].append(entry)
    if kind in "?*":
        parts.free[start].append(end)
    return end


class Automaton:
    """``successors[state][byte]``, ``accepts[state]`` (rule numbers), ``start`` and
    ``dead`` (the state without a way out, or -1)."""

    def __init__(self, rules: list[tuple[str, bool]], anywhere: bool = True, backwards: bool = False):
        """``rules``: expression, and whether letters stand for both cases.
        ``anywhere``: a match may begin at any byte."""
        parts = _Parts()
        first = parts.state()
        ends: dict[int, int] = {}
        if anywhere:
            parts.moves[first].append((ALL, first))
        for number, (text, fold) in enumerate(rules):
            entry = parts.state()
            parts.free[first].append(entry)
            ends[_build(parts, _Reader(text, fold).choice(), entry, backwards)] = number
        groups = self._byte_groups(parts)
        table, accepts = self._subsets(parts, first, ends, groups)
        self._minimise(table, accepts, groups)

    @staticmethod
    def _byte_groups(parts: _Parts) -> list[list[int]]:
        """Bytes that no move tells apart."""
        sets = {members for moves in parts.moves for members, _ in moves}
        found: dict[tuple, list[int]] = {}
        for byte in range(256):
            found.setdefault(tuple(byte in s for s in sets), []).append(byte)
        return list(found.values())

    @staticmethod
    def _subsets(parts, first, ends, groups):
        start = parts.closure([first])
        known, todo, table, accepts = {start: 0}, [start], [], []
        for subset in todo:
            accepts.append(frozenset(ends[s] for s in subset if s in ends))
            moves = [move for s in subset for move in parts.moves[s]]
            row = []
            for group in groups:
                target = parts.closure({t for members, t in moves if group[0] in members})
                if target not in known:
                    known[target] = len(known)
                    todo.append(target)
                row.append(known[target])
            table.append(row)
        return table, accepts

    def _minimise(self, table, accepts, groups) -> None:
        """Split states by what they accept, then by where they lead, until nothing splits."""
        kinds = {a: n for n, a in enumerate(dict.fromkeys(accepts))}
        block = [kinds[a] for a in accepts]
        while True:
            seen: dict[tuple, int] = {}
            split = [seen.setdefault((block[s], *(block[t] for t in row)), len(seen)) for s, row in enumerate(table)]
            if len(seen) == len(set(block)):
                break
            block = split
        count = max(block) + 1
        of_byte = [0] * 256
        for number, group in enumerate(groups):
            for byte in group:
                of_byte[byte] = number
        self.successors: list[list[int]] = [[] for _ in range(count)]
        self.accepts: list[frozenset] = [frozenset()] * count
        for state, row in enumerate(table):
            if not self.successors[block[state]]:
                self.successors[block[state]] = [block[row[of_byte[b]]] for b in range(256)]
                self.accepts[block[state]] = accepts[state]
        self.start = block[0]
        self.dead = next((s for s, row in enumerate(self.successors) if set(row) == {s} and not self.accepts[s]), -1)
