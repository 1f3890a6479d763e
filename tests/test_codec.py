import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spoolwire.functions.codec import (
    MalformedRecord,
    binary_deserializer,
    binary_serializer,
    decode_records_binary,
    encode_records,
)
from spoolwire.operators.records import deserialize
from spoolwire.sinks.topic import publish
from spoolwire.sources.topic import FileTopic, read_topic
from spoolwire.streaming.topic_stream import decode_records, stream_topic

NAMES = ["a", "b", "c"]


def by_hand(record):
    """The format, value by value."""
    out = b""
    for name in NAMES:
        text = record[name]
        out += struct.pack(">i", -1) if text is None else struct.pack(">i", len(text.encode())) + text.encode()
    return out


def struct_array(records):
    return pa.array(records, pa.struct([(n, pa.string()) for n in NAMES]))


texts = st.one_of(st.none(), st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=12))
some = st.lists(st.one_of(st.none(), st.fixed_dictionaries({n: texts for n in NAMES})), max_size=9)


@settings(max_examples=200, deadline=None)
@given(some, st.integers(0, 3))
def test_round_trip_and_bytes(records, skip):
    got = encode_records(struct_array(records)[skip:])
    records = records[skip:]
    assert got.to_pylist() == [None if r is None else by_hand(r) for r in records]
    assert decode_records_binary(got, NAMES, failfast=True).to_pylist() == records


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=20), max_size=6), st.integers(0, 2))
def test_any_bytes_decode_to_null_or_a_record_of_these_bytes(values, skip):
    array = pa.array(values, pa.binary())[skip:]
    for value, record in zip(values[skip:], decode_records_binary(array, NAMES).to_pylist(), strict=True):
        assert record is None or by_hand(record) == value


def test_malformed_values():
    good = by_hand({"a": "x", "b": None, "c": ""})
    bad = [
        good[:-1], good + b"!", b"", b"\0\0", good[:5] + struct.pack(">i", -2) + good[9:],
        struct.pack(">i", 2**31 - 1) + good[4:], good.replace(b"x", b"\xff"),
    ]
    got = decode_records_binary(pa.array([good, *bad, None, good], pa.binary()), NAMES)
    assert [r is not None for r in got.to_pylist()] == [True, *[False] * len(bad), False, True]
    for value in bad:
        with pytest.raises(MalformedRecord):
            decode_records_binary(pa.array([good, value], pa.binary()), NAMES, failfast=True)
    with pytest.raises(TypeError):
        encode_records(pa.array([{"a": 1}], pa.struct([("a", pa.int64())])))


def test_through_a_topic_batch_and_stream(spark, tmp):
    long_text = "é漢" * 1_500_000  # 7.5 MB in one value
    rows = [(1, "x", None, ""), (2, None, None, None), (3, long_text, "\n", "\0"), (4, "", "b", "c")]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string").repartition(2)
    topic = FileTopic(tmp, "data")
    publish(df, topic, columns=NAMES, serializer=binary_serializer, partitions=2, partition_by=F.col("id") % 2, order_by=["id"])
    env = deserialize(read_topic(spark, topic), binary_deserializer(NAMES, failfast=True))
    got = {(r["partition"], r["offset"]): tuple(r["record"]) for r in env.collect()}
    want = {(1, 0): rows[0][1:], (0, 0): rows[1][1:], (1, 1): rows[2][1:], (0, 1): rows[3][1:]}
    assert got == want
    stream = decode_records(stream_topic(spark, topic), deserializer=binary_deserializer(NAMES))
    query = stream.writeStream.format("memory").queryName("binary_stream").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {(r["partition"], r["offset"]): tuple(r["record"]) for r in spark.table("binary_stream").collect()} == want


def test_empty_and_null_records(spark):
    df = spark.createDataFrame([(None,)], "r struct<a:string>")
    assert df.select(binary_serializer(F.col("r")).alias("v")).first()["v"] is None
    none = df.where("false").select(binary_serializer(F.col("r")).alias("v"))
    assert none.select(binary_deserializer(["a"])(F.col("v")).alias("r")).count() == 0


def test_deserializer_is_of_spark_functions_and_agrees_with_arrow(spark):
    good = by_hand({"a": "x", "b": None, "c": "é"})
    values = [
        None, good, good[:-1], good + b"!", b"", b"\0\0", good[:5] + struct.pack(">i", -2) + good[9:], by_hand({"a": "", "b": "\0", "c": None}),
        struct.pack(">i", 2**31 - 1) + good[4:], struct.pack(">i", -(2**31)) + good[4:], good.replace(b"x", b"\xff"), struct.pack(">i", -1) * 3,
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v binary")
    read = df.select("i", binary_deserializer(NAMES)(F.col("v")).alias("r"))
    assert "Python" not in read._jdf.queryExecution().executedPlan().toString()
    want = decode_records_binary(pa.array(values, pa.binary()), NAMES).to_pylist()
    assert [r["r"] and r["r"].asDict() for r in read.orderBy("i").collect()] == want
    with pytest.raises(Exception, match="not a record of 3 fields"):
        df.select(binary_deserializer(NAMES, failfast=True)(F.col("v")).alias("r")).collect()
