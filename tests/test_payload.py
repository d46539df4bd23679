import pytest
from pyspark.sql import functions as F

from tidemark.functions import payload as J
from tidemark.operators import parse

ICIDS = [
    ('{"header":{"icid":7}}', "7"),
    ('{"header":{"icid":"a\\u00e9"}}', "aé"),
    ("{bad", "_"),
    ('{"header":{"icid":7', "_"),
    ("", ""),
    (" \n\t", ""),
    (None, ""),
    ("null", ""),
    ("{}", ""),
    ("[1]", "_"),
    ('[{"header":{"icid":7}}]', "_"),
    ("123", "_"),
    ('"x"', "_"),
    ("{'header':{'icid':7}}", "_"),
    ('{"header":null}', ""),
    ('{"header":{}}', ""),
    ('{"header":{"icid":null}}', ""),
    ('{"header":5}', ""),
    ('{"header":{"icid":"a"},"dimensions":7}', "a"),
    ('\t{"header":{"icid":true}}\n', "true"),
    ('{"header":{"icid":9007199254740993123}}', "9007199254740993123"),
    ('{"header":{"icid":"c1"}} junk', "_"),
    ('{"header":{"icid":"c1"}}}', "_"),
    ('{"header":{"icid":"c1"}}] junk', "_"),
    ('{"header":{"icid":"c1"}}, {}', "_"),
    ('{"header":{"icid":"c1"}} {"header":{"icid":"c2"}}', "_"),
    ('{"header":5,\'x\':1}', "_"),
    ('{"x":1,"x":2,"header":{"icid":"c1"}}', "c1"),
    ('{"header":{"icid":"c1"},"header":{"icid":"c2"}}', "c2"),
    ('{"document":1,"_malformed":"x","header":{"icid":"c1"}}', "c1"),
]


def test_icid(spark):
    frame = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(ICIDS)], "i int, p string")
    got = {r["i"]: r["v"] for r in frame.select("i", J.icid(F.col("p")).alias("v")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(ICIDS)}


def test_all_getters_agree_with_the_single_ones(spark):
    rows = [p for p, _ in ICIDS] + [
        '{"header":{"icid":"c","start":17},"dimensions":{"mo":{"imsi":"1"},"mt":{"imsi":""}}}',
        '{"dimensions":{"mo":{},"mt":null}}',
    ]
    frame = spark.createDataFrame([(p,) for p in rows], "p string")
    p = F.col("p")
    single = [J.icid(p), J.start(p), J.mo_imsi(p), J.mt_imsi(p)]
    got = frame.select(J.payload_fields(p).alias("all"), F.struct(*single).alias("one")).collect()
    assert all(tuple(r["all"]) == tuple(r["one"]) for r in got)
    assert tuple(got[-2]["all"]) == ("c", "17", "1", "")
    assert tuple(got[-1]["all"]) == ("", "", "", "")


def test_presence_lets_the_malformed_mark_pass(spark):
    frame = spark.createDataFrame([("1",), ("",), ("_",)], "mo_imsi string")
    assert {r[0] for r in parse.keep_present(frame, "mo_imsi").collect()} == {"1", "_"}


@pytest.mark.parametrize("text,valid", [("{}", True), ("[1]", True), ("{bad", False), ("", False), (None, False),
    ("7", True), ('"x"', True), ("null", True), ("{} junk", False), ("{}}", False), ("[]]", False), ("1,2", False), ("{'a':1}", False),
    ('{"a":1,"a":2}', True), ('{"a":1}, "b":{"c":2}', False)])
def test_json_filter(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "payload string")
    assert parse.keep_valid_json(frame).count() == int(valid)


def test_one_parse_for_four_getters(spark):
    frame = spark.createDataFrame([("{}",)], "p string").select(J.payload_fields(F.col("p")).alias("g"))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(document") == 1


def test_long_texts_stay_valid(spark):
    frame = spark.range(1).select(F.concat(F.lit('{"z":"'), F.repeat(F.lit("x"), 25_000_000), F.lit('","header":{"icid":"k"}}')).alias("payload"))
    assert frame.select(J.icid(F.col("payload"))).first()[0] == "k"
    assert parse.keep_valid_json(frame).count() == 1
