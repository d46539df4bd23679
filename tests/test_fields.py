import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fields as X
from tidemark.operators import parse

# line, fields, kept as datatype1, kept as datatype2, row key, payload
GOLDEN = [
    ("1517805000\t12345\tx\tpay", 4, True, True, "54321-1517805000", "pay"),
    ("1517805000\t12345\tx\tpay\tn", 5, True, False, "54321-1517805000", "pay"),
    ("t\tu\tx\t", 3, False, False, None, None),
    ("t\tu\tx\t\t", 3, False, False, None, None),
    ("t\tu\tx\t\tz", 5, True, False, "u-t", ""),
    ("t\tu\tx\tp\t\t\t", 4, True, True, "u-t", "p"),
    ("\tu\tx\tp", 4, True, True, "u-", "p"),
    ("t\t\tx\tp", 4, True, True, "-t", "p"),
    ("", 1, False, False, None, None),
    ("\t\t\t", 1, False, False, None, None),
    ("a\tb", 2, False, True, None, None),
    ("a\tb\tc\td\te\tf", 6, False, False, None, None),
    (" \tu v\té\tp p", 4, True, True, "v u- ", "p p"),
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(row[0],) for row in GOLDEN], "value string").coalesce(1)


def test_field_counts(lines):
    counts = {r["value"]: r["n"] for r in parse.with_fields(lines).select("value", F.size("fields").alias("n")).collect()}
    assert counts == {row[0]: row[1] for row in GOLDEN}


def test_arity_filters(lines):
    records = parse.with_fields(lines)
    kept1 = {r["value"] for r in parse.keep_datatype1(records).collect()}
    kept2 = {r["value"] for r in parse.keep_datatype2(records).collect()}
    assert kept1 == {row[0] for row in GOLDEN if row[2]}
    assert kept2 == {row[0] for row in GOLDEN if row[3]}


def test_keys_and_payloads(lines):
    got = {(r["userid_ts"], r["payload"]) for r in parse.parse_datatype1(lines).collect()}
    assert got == {(row[4], row[5]) for row in GOLDEN if row[2]}


def test_datatype2_keeps_positions(lines):
    rows = {tuple(r["fields"]) for r in parse.parse_datatype2(lines).collect()}
    assert ("a", "b") in rows and ("1517805000", "12345", "x", "pay") in rows


def test_key_length_limit(spark):
    rows = spark.createDataFrame([(32_766, "a"), (32_767, "a"), (32_768, "a"), (16_384, "é")], "n int, c string")
    keyed = rows.select("n", "c", F.expr("repeat(c, n)").alias("userid_ts"))
    assert {r["n"] for r in parse.keep_storable_keys(keyed).collect()} == {32_766, 32_767}


def test_cells_are_bytes(spark):
    keyed = spark.createDataFrame([("é-1", "p")], "userid_ts string, payload string")
    row = parse.cells(keyed).first()
    assert [bytes(v) for v in row] == ["é-1".encode(), b"data", b"payload", b"p"]


def test_one_cell_per_value(spark):
    schema = "userid_ts string, payload string, location_history string"
    keyed = spark.createDataFrame([("1-1", "p", None), ("2-1", "", "home")], schema)
    rows = parse.cells(keyed, ("payload", "location_history")).collect()
    assert {(bytes(r["row"]), bytes(r["qualifier"]), bytes(r["value"])) for r in rows} == {
        (b"1-1", b"payload", b"p"),
        (b"2-1", b"payload", b""),
        (b"2-1", b"location_history", b"home"),
    }


def test_random_lines(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("\t\t\tab é") for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r["i"]: r["fields"] for r in parse.with_fields(frame).collect()}
    assert got == {i: t.rstrip("\t").split("\t") for i, t in enumerate(texts)}


def test_line_is_split_once(lines):
    plan = parse.parse_datatype1(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
