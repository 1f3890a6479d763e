"""Streaming: the continuous job equals the bounded read; checkpoints prevent repeats."""

from pyspark.sql import functions as F

from spoolwire import FileTopic, publish, read_topic, run_stream, stream_topic
from spoolwire.streaming.topic_stream import decode_records, emit_records
from spoolwire.workspace import scratch_path


def _topic(spark, tmp, n=500):
    t = FileTopic(tmp)
    df = spark.range(n).select(F.col("id").cast("string").alias("id"))
    publish(df, t, partitions=2, partition_by=F.pmod(F.col("id").cast("long"), F.lit(2)), order_by=[F.col("id").cast("long")])
    return t


def test_stream_equals_batch_and_resumes(spark, tmp):
    t = _topic(spark, tmp)
    sink, cp = scratch_path(spark, "sink"), scratch_path(spark, "cp")
    run_stream(spark, t, sink, cp)
    out = spark.read.parquet(sink)
    batch = read_topic(spark, t).select("partition", "offset", F.col("value").cast("string").alias("value"))
    assert sorted(map(tuple, out.select("partition", "offset", "value").collect())) == sorted(map(tuple, batch.collect()))
    assert out.select(F.variant_get("json", "$.id", "string").alias("id")).filter("id is null").count() == 0
    run_stream(spark, t, sink, cp)  # same checkpoint: nothing new
    assert spark.read.parquet(sink).count() == 500
    publish(spark.range(500, 520).select(F.col("id").cast("string").alias("id")), t)
    run_stream(spark, t, sink, cp)  # only the new records
    assert spark.read.parquet(sink).count() == 520


def test_stream_from_offsets_and_memory_sink(spark, tmp):
    t = _topic(spark, tmp, 100)
    s = stream_topic(spark, t, starting={"0": 40})
    q = emit_records(decode_records(s), sink="memory", query_name="from_offsets")
    q.awaitTermination()
    got = spark.sql("select partition, offset from from_offsets").collect()
    assert len(got) == 100 - 40 and min(r.offset for r in got if r.partition == 0) == 40


def test_same_transforms_on_stream(spark, tmp):
    from spoolwire import parse_records, string_schema

    t = _topic(spark, tmp, 50)
    s = parse_records(stream_topic(spark, t), string_schema(["id"]))
    assert s.isStreaming and s.columns == ["key", "id"]
    q = emit_records(s, sink="memory", query_name="parsed_stream")
    q.awaitTermination()
    assert spark.sql("select count(*) c from parsed_stream").first().c == 50


def test_live_trigger_and_foreach_batch(spark, tmp):
    t = _topic(spark, tmp, 60)
    seen = []

    def collect_batch(batch_df, epoch_id):
        seen.extend((r.partition, r.offset) for r in batch_df.select("partition", "offset").collect())

    q = emit_records(decode_records(stream_topic(spark, t)), foreach_batch=collect_batch,
                     available_now=False, processing_time="200 milliseconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert len(seen) == 60 and len(set(seen)) == 60


def test_run_stream_live_mode(spark, tmp):
    t = _topic(spark, tmp, 40)
    sink, cp = scratch_path(spark, "sink"), scratch_path(spark, "cp")
    q = run_stream(spark, t, sink, cp, available_now=False)
    try:
        q.processAllAvailable()
        publish(spark.range(40, 45).select(F.col("id").cast("string").alias("id")), t)
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(sink).count() == 45


def test_stream_progress_reports_rates(spark, tmp):
    from spoolwire.streaming import stream_progress

    t = _topic(spark, tmp, 80)
    q = emit_records(decode_records(stream_topic(spark, t)), sink="memory", query_name="progress_q")
    q.awaitTermination()
    prog = stream_progress(spark, q).collect()
    assert sum(r.input_rows for r in prog) == 80
    assert all(r.processed_rows_per_second >= 0 for r in prog)


def test_fresh_checkpoint_starts_from_earliest(spark, tmp):
    # No committed consumer position; a new checkpoint replays the topic from the start
    t = _topic(spark, tmp, 30)
    first, second = scratch_path(spark, "sink"), scratch_path(spark, "sink")
    run_stream(spark, t, first, scratch_path(spark, "cp"))
    run_stream(spark, t, second, scratch_path(spark, "cp"))
    assert spark.read.parquet(first).count() == spark.read.parquet(second).count() == 30


def test_max_files_per_trigger_bounds_batches(spark, tmp):
    from spoolwire.streaming import stream_progress

    t = _topic(spark, tmp, 40)
    publish(spark.range(40, 80).select(F.col("id").cast("string").alias("id")), t)  # more files
    s = decode_records(stream_topic(spark, t, max_files_per_trigger=1))
    q = emit_records(s, sink="memory", query_name="bounded_batches")
    q.awaitTermination()
    prog = stream_progress(spark, q).collect()
    assert sum(r.input_rows for r in prog) == 80 and len([r for r in prog if r.input_rows]) > 1


def test_resume_from_latest_keeps_later_records(spark, tmp):
    t = _topic(spark, tmp, 20)
    sink, cp = scratch_path(spark, "sink"), scratch_path(spark, "cp")
    more = lambda lo, hi: publish(spark.range(lo, hi).select(F.col("id").cast("string").alias("id")), t)
    run_stream(spark, t, sink, cp, starting="latest")
    more(20, 30)
    run_stream(spark, t, sink, cp, starting="latest")
    more(30, 35)
    run_stream(spark, t, sink, cp, starting="latest")
    got = sorted(int(r.id) for r in spark.read.parquet(sink).select(F.variant_get("json", "$.id", "string").alias("id")).collect())
    assert got == list(range(20, 35))


def test_resume_with_latest_of_one_partition(spark, tmp):
    t = _topic(spark, tmp, 20)
    sink, cp = scratch_path(spark, "sink"), scratch_path(spark, "cp")
    run_stream(spark, t, sink, cp, starting={"0": -1})
    publish(spark.range(20, 40).select(F.col("id").cast("string").alias("id")), t)
    run_stream(spark, t, sink, cp, starting={"0": -1})
    assert spark.read.parquet(sink).count() == 30


def test_quarantine_routes_malformed_records(spark, tmp):
    from spoolwire import string_schema

    t = FileTopic(tmp)
    rows = spark.createDataFrame([('{"a":"1"}',), ("{bad",), (None,), ("{}",)], "value string")
    publish(rows.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")), t, wire=True)
    for schema in (None, string_schema(["a"])):
        sink = scratch_path(spark, "sink")
        run_stream(spark, t, sink, corrupt_column="_corrupt_record", schema=schema, max_files_per_trigger=1)
        bad = spark.read.parquet(f"{sink}/quarantined=true").collect()
        good = spark.read.parquet(f"{sink}/quarantined=false")
        assert [r["_corrupt_record"] for r in bad] == ["{bad"] and good.count() == 3
        if schema is not None:
            assert good.select("record.*").columns == ["a"]


def test_options_of_the_other_backend_are_refused(spark, tmp):
    import pytest

    from spoolwire import KafkaTopic

    t = _topic(spark, tmp, 4)
    with pytest.raises(ValueError):
        stream_topic(spark, t, max_offsets_per_trigger=5)
    with pytest.raises(ValueError):
        stream_topic(spark, t, fail_on_data_loss=True)
    with pytest.raises(ValueError):
        stream_topic(spark, KafkaTopic("data", "b:1"), max_files_per_trigger=5)
    with pytest.raises(ValueError):
        publish(spark.range(1).selectExpr("string(id) id"), KafkaTopic("data", "b:1"), partitions=3)
