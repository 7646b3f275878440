from tagweave.functions.rules import format_rule, parse_rule, source_spec
from tagweave.schemas import SOURCE_KEYS

RULE = "inType=cells##zkHosts=node-a,node-b##zkPort=4180##hbaseTable=/data/crm/cells##family=base##selectFields=id,segment"


def _parse(spark, text):
    df = spark.createDataFrame([(text,)], "rule STRING")
    return df.select(parse_rule("rule").alias("m")).first()["m"]


def test_golden_rule_string(spark):
    m = _parse(spark, RULE)
    assert m == {"inType": "cells", "zkHosts": "node-a,node-b", "zkPort": "4180",
                 "hbaseTable": "/data/crm/cells", "family": "base", "selectFields": "id,segment"}


def test_missing_key_defaults(spark):
    df = spark.createDataFrame([(RULE,)], "rule STRING")
    legacy = df.select(source_spec(parse_rule("rule"), "").alias("s")).first()["s"].asDict()
    model = df.select(source_spec(parse_rule("rule"), None).alias("s")).first()["s"].asDict()
    assert list(legacy) == list(SOURCE_KEYS)
    assert legacy["rowKey"] == "" and model["rowKey"] is None
    assert legacy["family"] == "base"


def test_edge_cases(spark):
    m = _parse(spark, "a=1####b=2=3##a=9##flag##")
    assert m == {"a": "9", "b": "2", "flag": None}


def test_empty_and_null(spark):
    df = spark.createDataFrame([("",), (None,)], "rule STRING")
    got = [r["m"] for r in df.select(parse_rule("rule").alias("m")).collect()]
    assert got[0] == {} and got[1] is None


def test_format_roundtrip(spark):
    pairs = [("inType", "parquet"), ("hbaseTable", "/data/users"), ("selectFields", "id,job")]
    assert _parse(spark, format_rule(pairs)) == dict(pairs)
