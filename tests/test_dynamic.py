"""The dynamic load: evolving tables, isolated failures, statuses, stored rejects."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorstar.operators import discovery
from sensorstar.plans.dynamic import EMPTY, ERROR, INTERRUPTED, SUCCESS, DynamicStaging
from sensorstar.session import literal_rows

AT = dt.datetime(2024, 1, 1)
BIG = 2**53 + 1


def landing(spark, payloads):
    rows = [(n, AT, topic, payload) for n, (topic, payload) in enumerate(payloads, 1)]
    return literal_rows(spark, "id long, time timestamp_ntz, topic string, payload string", rows)


def tables(spark, tmp_path, groups, **options):
    rows = [(group, topic) for group, topics in groups.items() for topic in topics]
    return DynamicStaging(spark, str(tmp_path / "dynamic"), literal_rows(spark, "group_id string, topic string", rows), **options).create()


def content(found, group):
    rows = found.table(group).drop("load_dttm").collect()
    return sorted((tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in rows), key=str)


MESSAGES = [
    ("a", '{"n": 1, "s": "x"}'),
    ("b", '{"flag": true, "n": 2.5}'),
    ("a", '{"n": %d}' % BIG),
    ("a", '{"n": "9007199254740995", "late": "2024-02-30"}'),
    ("b", '{"n": "3f not retrieved", "flag": "yes", "at": "2024-03-01T10:00:00Z"}'),
    ("a", '{"n": 2.5, "late": 7, "topic": "own", "landing_id": 5}'),
    ("b", '{"at": "not a time", "n": null}'),
    ("c", "no json"),
]
GROUPS = {"ab": ["a", "b"], "c": ["c"], "none": ["silent"]}


def test_two_halves_are_one(spark, tmp_path):
    messages = landing(spark, MESSAGES)
    one = tables(spark, tmp_path / "one", GROUPS)
    two = tables(spark, tmp_path / "two", GROUPS)
    assert [r.status for r in one.load(messages)] == [SUCCESS, SUCCESS, EMPTY]
    assert [(r.status, r.rows, r.columns_added) for r in two.load(messages, up_to_id=3)] == [(SUCCESS, 3, 3), (EMPTY, 0, 0), (EMPTY, 0, 0)]
    assert [(r.status, r.rows, r.columns_added) for r in two.load(messages)] == [(SUCCESS, 4, 4), (SUCCESS, 1, 1), (EMPTY, 0, 0)]
    for group in ("ab", "c", "none"):
        assert content(one, group) == content(two, group)
        assert one.columns(group) == two.columns(group)
        assert sorted(map(tuple, one.rejects(group).collect())) == sorted(map(tuple, two.rejects(group).collect()))
    # As it was after the first load, and nothing new to load.
    assert two.table("ab", 1).count() == 3 and "late" not in two.table("ab", 1).columns
    assert [r.status for r in two.load(messages)] == [EMPTY] * 3


def test_values_and_rejects(spark, tmp_path):
    found = tables(spark, tmp_path, GROUPS)
    found.load(landing(spark, MESSAGES))
    rows = {r["landing_id"]: r for r in found.table("ab").collect()}
    assert [rows[n]["n"] for n in range(1, 8) if n in rows] == [1, 2, BIG, BIG + 2, None, 2, None]
    assert rows[4]["late"] == "2024-02-30" and rows[6]["late"] == "7"
    assert rows[6]["payload__topic"] == "own" and rows[6]["payload__landing_id"] == 5 and rows[6]["topic"] == "a"
    assert rows[5]["at"] == dt.datetime(2024, 3, 1, 10) and rows[2]["flag"] is True and rows[5]["flag"] is None
    assert sorted(map(tuple, found.rejects("ab").collect())) == [
        (5, "b", "flag", "BOOLEAN", "yes"), (5, "b", "n", "BIGINT", "3f not retrieved"), (7, "b", "at", "TIMESTAMPTZ", "not a time"),
    ]
    assert [r["raw_value"] for r in found.table("c").collect()] == ["no json"]


def test_a_failing_group_leaves_the_others(spark, tmp_path):
    found = tables(spark, tmp_path, GROUPS, widest=5)
    results = {r.group_id: r for r in found.load(landing(spark, MESSAGES))}
    assert results["ab"].status == ERROR and "7 columns" in results["ab"].message
    assert results["c"].status == SUCCESS and found.table("c").count() == 1
    assert found.table("ab").count() == 0 and found.catalogue().where("group_id = 'ab'").count() == 0
    # The group keeps its mark and is loaded whole once its table may be wider.
    found.widest = 7
    results = {r.group_id: r for r in found.load(landing(spark, MESSAGES))}
    assert (results["ab"].status, results["ab"].rows, results["c"].status) == (SUCCESS, 7, EMPTY)
    statuses = found.run_events().groupBy("topic", "status").count().collect()
    assert ("ab", ERROR, 1) in map(tuple, statuses) and ("ab", SUCCESS, 1) in map(tuple, statuses)


def test_rejects_come_from_the_typed_columns(spark, tmp_path, monkeypatch):
    """Each column's values are conformed once, not again to find those that do not fit."""
    real, kinds = discovery.conformed, []

    def counted(value, kind):
        kinds.append(kind)
        return real(value, kind)

    monkeypatch.setattr(discovery, "conformed", counted)
    found = tables(spark, tmp_path, GROUPS)
    found.load(landing(spark, MESSAGES))
    assert len(kinds) == sum(len(found.columns(group)) for group in ("ab", "c"))
    rejects = sorted(tuple(r) for r in found.rejects("ab").select("landing_id", "path", "type", "text").collect())
    assert rejects == [
        (5, "flag", "BOOLEAN", "yes"), (5, "n", "BIGINT", "3f not retrieved"), (7, "at", "TIMESTAMPTZ", "not a time"),
    ]
    assert found.rejects("c").count() == 0


def test_a_group_that_dies_while_writing_is_written_again(spark, tmp_path, monkeypatch):
    found = tables(spark, tmp_path, GROUPS)
    wide = discovery.wide

    def failing(rows, *rest):
        out = wide(rows, *rest)
        wrong = F.when(F.col("landing_id") >= 5, F.raise_error(F.lit("disk full"))).otherwise(F.col("topic"))
        return out.withColumn("topic", wrong) if "n" in out.columns else out

    monkeypatch.setattr(discovery, "wide", failing)
    assert [r.status for r in found.load(landing(spark, MESSAGES))] == [ERROR, SUCCESS, EMPTY]
    monkeypatch.setattr(discovery, "wide", wide)
    assert [r.status for r in found.load(landing(spark, MESSAGES))] == [SUCCESS, EMPTY, EMPTY]
    whole = tables(spark, tmp_path / "whole", GROUPS)
    whole.load(landing(spark, MESSAGES))
    assert content(found, "ab") == content(whole, "ab")


@pytest.mark.parametrize("way", ["stop", "key"])
def test_an_interrupted_load_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, way):
    found = tables(spark, tmp_path, {"1": ["a"], "2": ["b"], "3": ["c"]})
    asked = iter(range(3))
    if way == "key":
        write = found._write

        def interrupted(rows, columns, group, load):
            if group == "2":
                raise KeyboardInterrupt
            return write(rows, columns, group, load)

        monkeypatch.setattr(found, "_write", interrupted)
        results = found.load(landing(spark, MESSAGES))
        monkeypatch.setattr(found, "_write", write)
    else:
        results = found.load(landing(spark, MESSAGES), stop=lambda: next(asked) == 1)
    assert [(r.group_id, r.status) for r in results] == [("1", SUCCESS), ("2", INTERRUPTED)]
    assert [r.status for r in found.load(landing(spark, MESSAGES))] == [EMPTY, SUCCESS, SUCCESS]


def test_nothing_is_left_behind(spark, tmp_path):
    found = tables(spark, tmp_path, GROUPS)
    found.load(landing(spark, MESSAGES))
    assert not any((tmp_path / "dynamic" / "incoming").glob("*"))


def test_names_of_groups(spark, tmp_path):
    with pytest.raises(ValueError, match="a/b"):
        tables(spark, tmp_path, {"a/b": ["x"]})


def test_empty_landing(spark, tmp_path):
    found = tables(spark, tmp_path, GROUPS)
    assert [r.status for r in found.load(landing(spark, []))] == [EMPTY] * 3
    assert found.table("ab").columns == ["landing_id", "original_time", "topic", "load_dttm"] and found.table("ab").count() == 0
    assert found.catalogue().count() == 0 and found.rejects("ab").count() == 0
