"""Streams that keep figures: exactly-once batches, live progress, holes as they arrive, resent records; schema drift."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwire import FileTopic, offset_gaps, progress, publish, read_topic
from spoolwire.operators.drift import declared_fields, record_fields, schema_drift
from spoolwire.streaming import (
    batch_writer,
    drop_resent,
    emit_records,
    live_progress,
    read_batches,
    read_progress,
    seen_gaps,
    stream_topic,
    watch_offsets,
)
from spoolwire.streaming.live import seen_buckets


def append(spark, topic, lo, hi, parts=2, hole=None):
    df = spark.range(lo, hi).select("id", F.col("id").cast("string").alias("n"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"))
    publish(df, topic, columns=["n"], partitions=parts, partition_by=F.pmod("id", F.lit(parts)), order_by=[F.col("id")], timestamp_column="ts")


def lossy(spark, tmp, batches):
    """An envelope folder that gets one file set per batch; every batch loses some offsets."""
    full = FileTopic(f"{tmp}-full")
    append(spark, full, 0, 4000)
    path = f"{tmp}-lossy"
    rows = read_topic(spark, full).where((F.col("offset") % 97 != 5) & ~F.col("offset").between(300, 420))

    def put(i):
        share = 2000 // batches
        rows.where(F.col("offset").between(i * share, (i + 1) * share - 1)).write.mode("append").partitionBy("partition").parquet(path)

    return FileTopic(path), put


def test_replayed_batch_replaces_its_rows(spark, tmp):
    t, out, chk = FileTopic(f"{tmp}-t"), f"{tmp}-out", f"{tmp}-chk"
    write, seen = batch_writer(out, lambda b: b.select("partition", "offset")), []

    def fails(batch, number):
        seen.append(number)
        write(batch, number)
        if number == 1:
            raise RuntimeError("lost")

    append(spark, t, 0, 100)
    emit_records(stream_topic(spark, t), checkpoint_location=chk, foreach_batch=fails).awaitTermination()
    append(spark, t, 100, 250)
    with pytest.raises(Exception, match="lost"):
        emit_records(stream_topic(spark, t), checkpoint_location=chk, foreach_batch=fails).awaitTermination()
    assert read_batches(spark, out).count() == 250  # written, not committed
    emit_records(stream_topic(spark, t), checkpoint_location=chk, foreach_batch=write).awaitTermination()
    append(spark, t, 250, 300)
    emit_records(stream_topic(spark, t), checkpoint_location=chk, foreach_batch=write).awaitTermination()
    got = read_batches(spark, out)
    assert seen == [0, 1] and got.count() == got.select("partition", "offset").distinct().count() == 300
    assert {r.batch_id: r["count"] for r in got.groupBy("batch_id").count().collect()} == {0: 100, 1: 150, 2: 50}


@pytest.mark.parametrize("bucket", [64, 1 << 20])
def test_live_progress_equals_the_batch_figures(spark, tmp, bucket):
    t, put = lossy(spark, tmp, 4)
    for i in range(4):
        put(i)
        live_progress(spark, t, f"{tmp}-p", f"{tmp}-c", every=150, bucket=bucket)
        want = sorted(map(tuple, progress(read_topic(spark, t), every=150).collect()))
        got = sorted((r.partition, r.line_count, r.rps) for r in read_progress(spark, f"{tmp}-p").collect())
        assert got == want and want
    assert read_progress(spark, f"{tmp}-p").select("batch_id").distinct().count() == 4
    with pytest.raises(Exception, match="another table"):
        put(0)
        live_progress(spark, t, f"{tmp}-elsewhere", f"{tmp}-c")


def test_stream_sees_the_holes_also_after_a_restart(spark, tmp):
    t, put = lossy(spark, tmp, 4)
    for i in range(4):
        put(i)
        watch_offsets(spark, t, f"{tmp}-w", f"{tmp}-wc", max_files_per_trigger=1, bucket=64)
        env = read_topic(spark, t)
        got = sorted(map(tuple, seen_gaps(spark, f"{tmp}-w", env, bucket=64).collect()))
        assert got == sorted(map(tuple, offset_gaps(env, bucket=64).collect())) and got
    # one small row per bucket, whatever the number of batches
    assert seen_buckets(spark, f"{tmp}-w").count() == 2 * (-(-2000 // 64) - 1)


def test_resent_records_are_dropped(spark, tmp):
    t, chk, out = FileTopic(f"{tmp}-t"), f"{tmp}-c", f"{tmp}-o"

    def drain():
        q = emit_records(drop_resent(stream_topic(spark, t), "1 hour"), "parquet", out, chk)
        q.awaitTermination()
        return q

    append(spark, t, 0, 400)
    append(spark, t, 350, 400)
    drain()
    append(spark, t, 380, 500)  # sent again after a restart, with new ones
    q = drain()
    got = spark.read.parquet(out)
    assert got.count() == got.select("value").distinct().count() == 500
    assert q.lastProgress.stateOperators[0].numRowsTotal == 500
    append(spark, t, 20_000, 20_001)  # hours later the state lets go of old ones
    drain()
    append(spark, t, 20_001, 20_002)
    assert drain().lastProgress.stateOperators[0].numRowsTotal <= 2
    assert spark.read.parquet(out).count() == 502


def test_records_with_null_values_are_distinct_by_timestamp(spark, tmp):
    t = FileTopic(tmp)
    rows = spark.range(20).select(F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), F.timestamp_seconds(F.col("id") % 10 + 1_700_000_000).alias("ts"))
    publish(rows, t, wire=True, timestamp_column="ts")
    emit_records(drop_resent(stream_topic(spark, t), "1 day"), "parquet", f"{tmp}-o", f"{tmp}-c").awaitTermination()
    assert spark.read.parquet(f"{tmp}-o").count() == 10


def drift_rows(spark, records):
    return spark.createDataFrame([(i % 2, i, r) for i, r in enumerate(records)], "partition int, offset long, value string")


NESTED = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()), T.StructField("n", T.StructType([T.StructField("x", T.LongType())]))])


def test_schema_drift_by_hand(spark):
    records = ['{"a":"x","b":1,"n":{"x":1}}', '{"a":1,"b":"q","n":{"x":"s","y":[1]}}', '{"a":null,"b":2.5,"n":7}', "[1]", "nope", None, "null", '{"a":"z","b":1,"n":{},"c":{"d":true}}']
    got = {(r.partition, r.path, r.drift, r.found): (r.declared, r.records, r.first_offset) for r in schema_drift(drift_rows(spark, records), NESTED).collect()}
    added = {(1, "$.n.y", "added", "ARRAY"): (None, 1, 1), (1, "$.c", "added", "OBJECT"): (None, 1, 7), (1, "$.c.d", "added", "BOOLEAN"): (None, 1, 7)}
    changed = {
        (1, "$.a", "changed", "BIGINT"): ("STRING", 1, 1), (1, "$.b", "changed", "STRING"): ("NUMBER", 1, 1), (1, "$.n.x", "changed", "STRING"): ("BIGINT", 1, 1),
        (0, "$.n", "changed", "BIGINT"): ("OBJECT", 1, 2), (1, "$", "changed", "ARRAY"): ("OBJECT", 1, 3), (0, "$", "changed", "MALFORMED"): ("OBJECT", 1, 4),
        (1, "$", "changed", "MALFORMED"): ("OBJECT", 1, 5), (0, "$", "changed", "VOID"): ("OBJECT", 1, 6),
    }
    missing = {(p, path, "missing", None): (t, 2, 4 if p == 0 else 3) for p in (0, 1) for path, t in (("$.a", "STRING"), ("$.b", "NUMBER"), ("$.n", "OBJECT"))}
    missing |= {(0, "$.n.x", "missing", None): ("BIGINT", 3, 2), (1, "$.n.x", "missing", None): ("BIGINT", 3, 3)}
    assert got == {**added, **changed, **missing}


def test_schema_drift_edges(spark):
    assert declared_fields(NESTED) == {"$.a": "STRING", "$.b": "NUMBER", "$.n": "OBJECT", "$.n.x": "BIGINT"}
    assert schema_drift(drift_rows(spark, []), NESTED).count() == 0
    assert schema_drift(drift_rows(spark, ['{"a":"x","b":1.5,"n":{"x":2}}'] * 3), NESTED).count() == 0
    deep = '{"a":{"b":{"c":{"d":{"e":1}}}}}'
    paths = {r.path for r in record_fields(drift_rows(spark, [deep]), depth=3).collect()}
    assert paths == {"$", "$.a", "$.a.b", "$.a.b.c"}
    one = record_fields(drift_rows(spark, ['{"k":1,"l":{"m":2,"o":3},"p":{}}']))
    assert sorted(r.path for r in one.collect()) == ["$", "$.k", "$.l", "$.l.m", "$.l.o", "$.p"]
