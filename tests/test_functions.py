
import pytest
from pyspark.sql import functions as F

from spoolwire import FileTopic, decode_strict, head_chars, progress, publish, read_topic, to_wire, upload_csv, utf8_ok
from spoolwire.functions.text import csv_tokens, utf8_repair, utf8_require


def test_to_wire_keeps_nulls_and_non_ascii(spark):
    df = spark.createDataFrame([("1", None, "北京")], "ID string, `年份` string, `地区` string")
    r = to_wire(df).first()
    assert r.key is None
    assert bytes(r.value).decode("utf-8") == '{"ID":"1","年份":null,"地区":"北京"}'


def test_to_wire_key_and_custom_serializer(spark):
    df = spark.createDataFrame([("k1", "a,b")], "id string, v string")
    r = to_wire(df, key_column="id", serializer=F.to_csv).first()
    assert bytes(r.key) == b"k1" and bytes(r.value).decode() == 'k1,"a,b"'


def test_head_chars_counts_characters(spark):
    df = spark.createDataFrame([("中文ab",)], "t string")
    assert df.select(head_chars("t", 3).alias("h")).first().h == "中文a"


def test_utf8_functions(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xe4\xb8\xad"),), (bytearray(b"bad \xff"),)], "b binary")
    got = df.select(utf8_ok("b").alias("ok"), utf8_repair("b").alias("fixed")).collect()
    assert [r.ok for r in got] == [True, False]
    assert got[1].fixed == "bad �"
    with pytest.raises(Exception, match="INVALID_UTF8"):
        df.select(utf8_require("b")).collect()
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        df.select(decode_strict("b")).collect()


def test_csv_tokens(spark):
    df = spark.createDataFrame([('1,"a, ""b""",,x',), (",",), ('"",""""',)], "raw string")
    got = [r.t for r in df.select(csv_tokens("raw").alias("t")).collect()]
    assert got == [["1", 'a, "b"', "", "x"], ["", ""], ["", '"']]


def test_progress_rate_null_when_no_time_passes(spark, tmp):
    t = FileTopic(tmp)
    publish(spark.range(10).select(F.col("id").cast("string").alias("id")), t)  # one write time for all
    got = progress(read_topic(spark, t), every=2).collect()
    assert got and all(r.rps is None for r in got)


def test_failed_audit_publishes_nothing(spark, local_dir, tmp):
    from conftest import write_bytes

    bad = write_bytes(local_dir, "late-bad.csv", b"a,b\n" + b"1,2\n" * 5000 + b"3,\xff\n")
    t = FileTopic(tmp)
    r = upload_csv(spark, bad, t, raise_errors=False).first()
    assert r.status == "failed"
    assert read_topic(spark, t).count() == 0


def test_wire_json_equal_as_json_not_bytes(spark):
    # Python's json.dumps puts spaces after ':' and ','; Spark does not. Same JSON value.
    import json

    row = {"ID": "1", "年份": None, "地区": "北京"}
    df = spark.createDataFrame([tuple(row.values())], "ID string, `年份` string, `地区` string")
    wire = bytes(to_wire(df).first().value).decode("utf-8")
    python_text = json.dumps(row, ensure_ascii=False)
    assert wire != python_text and json.loads(wire) == json.loads(python_text)
