"""JSON parsing semantics (FIXTURES.md §6) and schemaless parsing."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwire import parse_any, parse_records
from spoolwire.functions.json import parse_json_struct

SCHEMA = T.StructType([T.StructField("ID", T.StringType()), T.StructField("年份", T.StringType())])

CASES = [
    ('{"ID":"1","年份":"2001"}', ("1", "2001"), None),
    ('{"ID":"1"}', ("1", None), None),
    ('{"ID":"1","x":2}', ("1", None), None),
    ('{"id":"1"}', (None, None), None),
    ('{"ID":"a","ID":"b"}', ("b", None), None),
    ('{"ID":1.50}', ("1.5", None), None),
    ('{"ID":true} x', ("true", None), None),
    ("{bad", (None, None), "{bad"),
    ('"s"', (None, None), '"s"'),
    ("5", (None, None), "5"),
    ("[]", (None, None), "[]"),
    ("null", (None, None), "null"),
    ("{}", (None, None), None),
]


def test_declared_schema_cases(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(CASES)], "i int, value string")
    out = parse_records(df, SCHEMA, keep=("i",), corrupt_column="_corrupt_record")
    got = {r.i: (r.ID, r["年份"], r._corrupt_record) for r in out.collect()}
    for i, (_, fields, corrupt) in enumerate(CASES):
        assert got[i] == fields + (corrupt,), CASES[i]


def test_null_and_empty_give_null_struct(spark):
    df = spark.createDataFrame([("",), (None,)], "value string")
    got = df.select(parse_json_struct("value", SCHEMA, "_corrupt_record").alias("p")).collect()
    assert [r.p for r in got] == [None, None]


def test_binary_envelope_input(spark):
    df = spark.createDataFrame([(None, bytearray('{"ID":"7"}'.encode()))], "key binary, value binary")
    r = parse_records(df, SCHEMA).first()
    assert (r.key, r.ID, r["年份"]) == (None, "7", None)


def test_keep_clash_rejected(spark):
    df = spark.createDataFrame([("{}",)], "value string").withColumn("ID", F.lit("x"))
    with pytest.raises(ValueError):
        parse_records(df, SCHEMA, keep=("ID",))


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([("{bad",)], "value string")
    with pytest.raises(Exception):
        parse_records(df, SCHEMA, keep=(), mode="strict").collect()


def test_parse_any(spark):
    df = spark.createDataFrame([('{"k": 5, "s": "x"}',), ("{bad",), ("[1,2]",)], "value string")
    out = parse_any(df).select(
        F.variant_get("json", "$.k", "bigint").alias("k"), F.schema_of_variant("json").alias("s")
    ).collect()
    assert out[0].k == 5 and out[0].s == "OBJECT<k: BIGINT, s: STRING>"
    assert out[1].k is None and out[1].s is None
    assert out[2].s == "ARRAY<BIGINT>"


def test_parse_any_strict_raises(spark):
    df = spark.createDataFrame([("{bad",)], "value string")
    with pytest.raises(Exception):
        parse_any(df, mode="strict").collect()
