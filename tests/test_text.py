from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorstar.functions import numbers, text, timeparts


def one_by_one(spark, function, values, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    found = rows.select("n", function(F.col("v")).alias("r")).orderBy("n").collect()
    return [r["r"] for r in found]


@pytest.mark.parametrize(
    ("topic", "city"),
    [
        ("/Bilina/kamery/camea/1", "Bilina"),
        ("/Bilina/kamery", "Unknown"),
        ("Bilina/kamery/camea", "Unknown"),
        ("/a/b/c/", "a"),
        ("//a/b/c", "a"),
    ],
)
def test_city_from_topic(spark, topic, city):
    assert one_by_one(spark, text.city_from_topic, [topic]) == [city]


def test_city_by_position(spark):
    assert one_by_one(spark, text.city_by_position, ["/x/y", "x", "/ /y", "a/b"]) == ["x", None, None, "b"]


def test_column_names(spark):
    names = {
        "Temp-1": "temp_1",
        "__x__": "x",
        "9lives": "col_9lives",
        "é": "col_",
        "": "col_",
        "a.b": "a_b",
        "A  B": "a_b",
        "-": "col_",
        " x_ _y ": "x_y",
        "Teplota °C": "teplota_c",
    }
    assert one_by_one(spark, text.column_name, list(names)) == list(names.values())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="aZ9_-. é/ß", max_size=12), min_size=30, max_size=60))
def test_column_names_of_any_text(spark, names):
    found = one_by_one(spark, text.column_name, names)
    assert all(re.fullmatch(r"col_|[a-z](_?[a-z0-9])*", name) for name in found)
    assert one_by_one(spark, text.column_name, [n for n in found if n != "col_"]) == [n for n in found if n != "col_"]
    kept = [[c for c in name.lower() if c.isascii() and c.isalnum()] for name in names]
    assert [[c for c in name.removeprefix("col_") if c != "_"] for name in found] == kept


def test_topic_names(spark):
    topics = ["/Energo/DCUK/A-1/act", "//a//b", "a:b.c"]
    assert one_by_one(spark, text.logical_topic, topics) == ["/Energo/DCUK/A-1", "/a/b", "/a:b.c"]
    assert one_by_one(spark, text.topic_table, topics) == ["stg_energo_dcuk_a_1_act", "stg_a_b", "stg_a_b_c"]


def test_bytes_in_three_encodings(spark):
    payloads = {
        "čaj".encode(): "čaj",
        "čaj".encode("cp1250"): "čaj",
        b"\x81\xe8": "\x81è",
        b"": "",
        b"plain": "plain",
        b"\xff": "˙",
        b"Sm\xedchov \x8a": "Smíchov Š",
    }
    assert one_by_one(spark, text.decode_bytes, list(payloads), "binary") == list(payloads.values())


def test_every_single_byte(spark):
    upper = [bytes([b]) for b in range(128, 256)]
    central = [b.decode("cp1250", errors="ignore") or chr(b[0]) for b in upper]
    assert one_by_one(spark, text.decode_bytes, upper, "binary") == central


def test_repair_of_text_read_wrongly(spark):
    values = {"Ä\x8daj": "čaj", "plain": "plain", "caf\xe9": "caf", "€uro": "uro"}
    assert one_by_one(spark, text.repair_utf8_read_as_latin1, list(values)) == list(values.values())


def test_numbers(spark):
    values = ["12", " 7 ", "12.7", "3f", "0", "", "-1.5e2", "nan", None]
    assert one_by_one(spark, numbers.whole_number, values) == [12, 7, None, None, 0, None, None, None, None]
    assert one_by_one(spark, numbers.truthy_number, values) == [12, 7, 12, None, None, None, -150, None, None]
    assert one_by_one(spark, numbers.number_or_null, values) == [12.0, 7.0, 12.7, None, 0.0, None, -150.0, None, None]


def test_strict_times(spark):
    values = ["2024-01-02 03:04:05.5", "2024-01-02 03:04:05", "2024-01-02T03:04:05.5", "2024-13-02 03:04:05.5", "x"]
    found = one_by_one(spark, timeparts.parse_utc, values)
    assert [v is not None for v in found] == [True, False, False, False, False]
    assert found[0].microsecond == 500_000


def test_time_keys_do_not_depend_on_the_zone(spark):
    stamps = ["2024-01-01 00:00:59", "2024-03-31 02:30:00", "2025-12-31 23:59:59", "2026-01-01 00:00:00", "2023-12-31 23:59:59"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Prague"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            keys = one_by_one(spark, lambda c: timeparts.time_key(c.cast("timestamp_ntz")), stamps)
            assert keys == [1104071, 1104071 + 90 * 1440 + 150, 1104071 + 731 * 1440 - 1, -1, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_czech_labels(spark):
    row = spark.range(1).select(
        timeparts.month_year_label(F.lit(2024), F.lit(3)).alias("label"), timeparts.czech_month(F.lit(12)).alias("month")
    )
    assert tuple(row.first()) == ("2024-03 Březen", "Prosinec")
