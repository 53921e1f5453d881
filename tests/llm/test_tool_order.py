"""The order of tool calls against a plain graph, and awkward rows."""

from __future__ import annotations

import json
import random
from collections import defaultdict

import pytest

from sensorstar.llm import tool_calls

CALL = "conv_id long, call_id string, position long, name string, arguments string, line string"
RESULT = "conv_id long, call_id string, position long, content string"
SCHEMAS = {"add": [("after", "array", False)]}


def call(conv, name, position, *after):
    return (conv, name, position, "add", json.dumps({"after": list(after)}) if after else "{}", "clash")


def linked(spark, calls, results=(), schemas=SCHEMAS):
    found = tool_calls.link_calls(spark.createDataFrame(list(calls), CALL), spark.createDataFrame(list(results), RESULT), schemas)
    assert found.columns == tool_calls.COLUMNS
    return found.collect()


def check(spark, calls):
    """Every call after what it needs; circles, and only they, with what is behind them."""
    rows = linked(spark, calls)
    assert len(rows) == len(calls)
    by_conv = defaultdict(list)
    for row in rows:
        by_conv[row["conv_id"]].append(row)
    for conv, found in by_conv.items():
        graph = {c[1]: set(json.loads(c[4]).get("after", [])) for c in calls if c[0] == conv}
        graph = {c: needs & set(graph) for c, needs in graph.items()}
        left = dict(graph)
        while ready := [c for c, needs in left.items() if not needs & set(left)]:
            for c in ready:
                del left[c]
        order = {r["call_id"]: r["order_no"] for r in found}
        assert sorted(order.values()) == list(range(1, len(found) + 1))
        assert {r["call_id"] for r in found if r["status"] == "cyclic"} == set(left)
        for c, needs in graph.items():
            assert c in left or all(order[n] < order[c] for n in needs)
        position = {c[1]: c[2] for c in calls if c[0] == conv}
        still = all(position[n] < position[c] for c, needs in graph.items() for n in needs)
        if still:
            assert sorted(order, key=order.get) == sorted(position, key=position.get)


def chain(conv, length, forward=True):
    """Each call needs the next, or the one before."""
    step = 1 if forward else -1
    return [call(conv, f"c{n}", n, *([f"c{n + step}"] if 0 <= n + step < length else [])) for n in range(length)]


def test_chains_and_diamonds(spark):
    calls = [*chain(1, 2), *chain(2, 3), *chain(3, 4), *chain(4, 50, forward=False)]
    calls += [call(5, "a", 0, "b", "c"), call(5, "b", 1, "d"), call(5, "c", 2, "d"), call(5, "d", 3), call(5, "e", 4, "a")]
    check(spark, calls)


def test_a_long_chain_that_points_forward(spark):
    check(spark, chain(1, 20))


def test_circles_with_tails(spark):
    calls = [call(1, "a", 0, "b"), call(1, "b", 1, "c"), call(1, "c", 2, "a"), call(1, "d", 3, "c"), call(1, "e", 4, "d"), call(1, "f", 5)]
    calls += [call(1, "g", 6, "f"), call(2, "x", 0, "x"), call(2, "y", 1, "z"), call(2, "z", 2), call(2, "w", 3, "y", "x")]
    check(spark, calls)


@pytest.mark.parametrize("seed", range(3))
def test_any_graph(spark, seed):
    rng, calls = random.Random(seed), []
    for conv in range(12):
        count = rng.randrange(1, 14)
        for n in range(count):
            needs = [f"c{rng.randrange(count + 2)}" for _ in range(rng.choice([0, 0, 1, 1, 2]))]
            calls.append(call(conv, f"c{n}", n, *needs))
    rng.shuffle(calls)
    check(spark, calls)


def test_repeated_rows_and_positions(spark):
    """Rows that repeat, ids used again, equal and null positions."""
    calls = [call(1, "a", 0), call(1, "a", 0), call(1, "a", 3), call(1, "c", 1, "b"), call(1, "b", 1), call(1, "z", None, "y"), call(1, "y", None)]
    calls += [call(None, "a", 0), call(2, None, 0), call(2, None, 0)]
    rows = linked(spark, calls, [(1, "a", 9, "done")])
    found = sorted((r["conv_id"] or 0, r["order_no"] or 0, r["call_id"], r["status"]) for r in rows if r["conv_id"] == 1)
    assert found == [
        (1, 1, "a", "linked"), (1, 2, "a", "repeated"), (1, 3, "b", "waiting"), (1, 4, "c", "waiting"), (1, 5, "a", "repeated"),
        (1, 6, "y", "waiting"), (1, 7, "z", "waiting"),
    ]
    others = sorted((r["conv_id"] or 0, r["order_no"] or 0, r["status"]) for r in rows if r["conv_id"] != 1)
    assert others == [(0, 0, "waiting"), (2, 1, "waiting"), (2, 2, "waiting")]


def test_types_names_and_long_texts(spark):
    schemas = {"add": [("a.b", "number", True), ("it's", "object", False), ('"q"', ("x", "y"), False), ("l", "array", False), ("t", "string", False)]}
    good = json.dumps({"a.b": 1.5, "it's": {"k": [1]}, '"q"': "y", "l": [], "t": "w " * 200_000})
    bad = json.dumps({"a.b": "1", "it's": [], '"q"': "z", "l": {}, "t": None})
    rows = linked(spark, [(1, "a", 0, "add", good, ""), (1, "b", 1, "add", bad, "")], schemas=schemas)
    assert {r["call_id"]: r["errors"] for r in rows} == {
        "a": "", "b": "not number: a.b; not object: it's; not one of x|y: \"q\"; not array: l; not string: t",
    }
    assert json.loads(next(r["line"] for r in rows if r["call_id"] == "a"))["arguments"] == json.loads(good)


def test_empty_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string, line string")
    assert tool_calls.conversation_calls(turns).count() == 0


def test_no_call_of_the_conversations_comes_before_its_need(spark, sf_dir):
    calls, _ = tool_calls.turns_as_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    rows = [tuple(r) for r in calls.select("conv_id", "call_id", "position", "name", "arguments").collect()]
    found = {(r["conv_id"], r["call_id"]): r for r in tool_calls.conversation_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()}
    graph = {}
    for conv, name, _, _, arguments in rows:
        try:
            need = json.loads(arguments).get("after")
        except ValueError:
            need = None
        graph[conv, name] = (conv, need)
    graph = {c: n if n in graph else None for c, n in graph.items()}
    for c, n in graph.items():
        seen = set()
        at = c
        while at is not None and at not in seen:
            seen.add(at)
            at = graph[at]
        assert (found[c]["status"] == "cyclic") == (at is not None)
        assert n is None or at is not None or found[n]["order_no"] < found[c]["order_no"]
