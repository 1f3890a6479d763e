"""Topic publish and read: dense offsets, placement, ranges, data loss, Kafka options."""

import json

import pytest
from pyspark.sql import functions as F

from spoolwire import DataLossError, FileTopic, offset_gaps, publish, read_topic
from spoolwire.sinks.topic import PRODUCER_SETTINGS
from spoolwire.sources.topic import EARLIEST, create_topic, end_offsets, kafka_offsets_json, parse_offsets


def dense(env):
    """Every partition's offsets are exactly 0..n-1."""
    stats = env.groupBy("partition").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count("*").alias("n"),
        F.count_distinct("offset").alias("d"),
    ).collect()
    return all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in stats), {r.partition: r.n for r in stats}


def records(spark, n, parts=4):
    return spark.range(n, numPartitions=parts).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 7).cast("string").alias("grp")
    )


def test_keyless_spreads_and_is_dense(spark, tmp):
    t = FileTopic(tmp)
    r = publish(records(spark, 5000, parts=1), t, partitions=3)
    assert r.rows_sent == 5000
    ok, counts = dense(read_topic(spark, t))
    assert ok and len(counts) == 3 and sum(counts.values()) == 5000
    assert max(counts.values()) - min(counts.values()) <= 1


def test_small_publishes_and_null_keys_spread(spark, tmp):
    t = FileTopic(tmp)
    for i in range(4):
        publish(records(spark, 10, parts=1), t, partitions=4 if not i else None)
    ok, counts = dense(read_topic(spark, t))
    assert ok and sum(counts.values()) == 40 and len(counts) == 4 and max(counts.values()) <= 13
    t = FileTopic(tmp + "-null")
    publish(records(spark, 100).withColumn("k", F.lit(None).cast("string")), t, key_column="k", partitions=4)
    ok, counts = dense(read_topic(spark, t))
    assert ok and len(counts) == 4 and max(counts.values()) < 50


def test_stage_is_gone_and_broken_publish_reuses_no_offset(spark, tmp, monkeypatch):
    import glob

    from spoolwire.sinks import topic as sink
    from spoolwire.workspace import shared_root

    t = FileTopic(tmp)
    publish(records(spark, 100), t, partitions=2, key_column="grp")
    assert not glob.glob(f"{shared_root(spark).removeprefix('file:')}/spoolwire/stage-*/*")
    with monkeypatch.context() as m:
        m.setattr(sink, "record_end_offsets", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            publish(records(spark, 30), t)
    assert publish(records(spark, 20), t).rows_sent == 20
    ok, counts = dense(read_topic(spark, t))
    assert ok and sum(counts.values()) == 150


def test_missing_ranges_against_recorded_ends(spark, tmp):
    from spoolwire.sources.topic import missing_ranges, record_end_offsets

    t = FileTopic(tmp)
    publish(records(spark, 200), t, partitions=4, partition_by=F.pmod(F.col("id").cast("long"), F.lit(4)), order_by=[F.col("id").cast("long")])
    lossy = FileTopic(tmp + "-lossy")
    p, o = F.col("partition"), F.col("offset")
    read_topic(spark, t).filter(((p == 0) & (o < 40)) | ((p == 1) & (o >= 7) & ~o.between(20, 21)) | (p == 2)).write.partitionBy("partition").parquet(lossy.path)
    record_end_offsets(spark, lossy, {i: 50 for i in range(4)})
    want = [(0, 40, 50, 10), (1, 0, 7, 7), (1, 20, 22, 2), (3, 0, 50, 50)]
    assert sorted(map(tuple, missing_ranges(spark, lossy).collect())) == want
    for spec in ({"0": 45, "1": 7, "3": -1}, {"0": -1, "1": 30}, {"0": -1, "1": 3, "3": -1}):
        with pytest.raises(DataLossError):
            read_topic(spark, lossy, starting=spec, fail_on_data_loss=True)
    read_topic(spark, lossy, starting={"0": -1, "1": 22, "3": -1}, fail_on_data_loss=True)
    read_topic(spark, lossy, starting={"1": 22, "3": -1}, ending={"0": 40}, fail_on_data_loss=True)
    assert missing_ranges(spark, t).count() == 0
    gone = FileTopic(tmp + "-gone")
    record_end_offsets(spark, gone, {0: 5})
    assert [tuple(r) for r in missing_ranges(spark, gone).collect()] == [(0, 0, 5, 5)]


def test_ordered_publish_offsets_follow_order(spark, tmp):
    t = FileTopic(tmp)
    df = records(spark, 3000)
    publish(df, t, partitions=3, partition_by=F.pmod(F.col("id").cast("long"), F.lit(3)),
            order_by=[F.col("id").cast("long")])
    env = read_topic(spark, t)
    got = env.select("partition", "offset", F.get_json_object(F.col("value").cast("string"), "$.id").cast("long").alias("id"))
    for r in got.collect():
        assert r.partition == r.id % 3 and r.offset == r.id // 3


def test_keyed_publish_same_key_same_partition(spark, tmp):
    t = FileTopic(tmp)
    publish(records(spark, 2000), t, key_column="grp", partitions=4)
    env = read_topic(spark, t)
    ok, _ = dense(env)
    assert ok
    per_key = env.groupBy(F.col("key").cast("string")).agg(F.count_distinct("partition").alias("p")).collect()
    assert all(r.p == 1 for r in per_key) and len(per_key) == 7


def test_hot_key_ordered_publish_stays_dense(spark, tmp):
    # a third of all rows on one key: range partitioning splits it across tasks
    t = FileTopic(tmp)
    df = spark.range(6000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    publish(df, t, key_column="k", partitions=2, order_by=["k"])
    ok, counts = dense(read_topic(spark, t))
    assert ok and sum(counts.values()) == 6000


def test_append_continues_offsets(spark, tmp):
    t = FileTopic(tmp)
    publish(records(spark, 100), t, partitions=2)
    publish(records(spark, 50), t)
    ok, counts = dense(read_topic(spark, t))
    assert ok and sum(counts.values()) == 150
    ends = {r.partition: r.end_offset for r in end_offsets(spark, t).collect()}
    assert ends == counts


def test_partition_count_mismatch(spark, tmp):
    t = FileTopic(tmp)
    create_topic(spark, t, 2)
    with pytest.raises(ValueError):
        publish(records(spark, 10), t, partitions=3)


def test_partition_out_of_range(spark, tmp):
    with pytest.raises(ValueError):
        publish(records(spark, 10), FileTopic(tmp), partitions=2, partition_by=F.lit(5))


def test_empty_publish_and_empty_topic(spark, tmp):
    t = FileTopic(tmp)
    assert read_topic(spark, t).count() == 0
    r = publish(records(spark, 0), t, partitions=2)
    assert r.rows_sent == 0 and read_topic(spark, t).count() == 0


def test_envelope_schema(spark, tmp):
    t = FileTopic(tmp, "data")
    publish(records(spark, 10), t)
    env = read_topic(spark, t)
    assert env.dtypes == [("key", "binary"), ("value", "binary"), ("topic", "string"), ("partition", "int"),
                          ("offset", "bigint"), ("timestamp", "timestamp"), ("timestampType", "int")]
    r = env.first()
    assert r.topic == "data" and r.key is None and r.timestampType == 0
    assert json.loads(bytes(r.value).decode())["id"] is not None


def test_offset_ranges_and_pushdown(spark, tmp):
    t = FileTopic(tmp)
    publish(records(spark, 300), t, partitions=3, partition_by=F.pmod(F.col("id").cast("long"), F.lit(3)),
            order_by=[F.col("id").cast("long")])
    env = read_topic(spark, t, starting={"0": 10, "1": -2}, ending={"2": 50})
    got = {(r.partition, r.offset) for r in env.select("partition", "offset").collect()}
    want = {(0, o) for o in range(10, 100)} | {(1, o) for o in range(100)} | {(2, o) for o in range(50)}
    assert got == want
    plan = env._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "PartitionFilters" in plan
    with pytest.raises(ValueError):
        read_topic(spark, t, starting="latest")


def test_fail_on_data_loss(spark, tmp):
    t = FileTopic(tmp)
    publish(records(spark, 200), t, partitions=2, partition_by=F.pmod(F.col("id").cast("long"), F.lit(2)),
            order_by=[F.col("id").cast("long")])
    env = read_topic(spark, t)
    lossy = FileTopic(tmp + "-lossy")
    env.filter(~((F.col("partition") == 1) & F.col("offset").between(10, 14))).write.partitionBy(
        "partition").parquet(lossy.path)
    assert read_topic(spark, lossy).count() == 195
    with pytest.raises(DataLossError):
        read_topic(spark, lossy, fail_on_data_loss=True)
    read_topic(spark, t, fail_on_data_loss=True)  # intact topic passes
    gaps = offset_gaps(read_topic(spark, lossy), bucket=8).collect()
    assert [(g.partition, g.offset, g.next_offset, g.missing) for g in gaps] == [(1, 9, 15, 5)]


def test_offset_gaps_against_brute_force(spark, tmp):
    import random

    rnd = random.Random(7)
    present = [(p, o) for p in range(3) for o in range(500) if rnd.random() > 0.1]
    df = spark.createDataFrame(present, "partition int, offset long")
    got = sorted(tuple(r) for r in offset_gaps(df, bucket=16).collect())
    want = []
    for p in range(3):
        offs = sorted(o for q, o in present if q == p)
        want += [(p, a, b, b - a - 1) for a, b in zip(offs, offs[1:]) if b > a + 1]
    assert got == sorted(want)


def test_offsets_options():
    assert parse_offsets("earliest", "data", EARLIEST) == EARLIEST
    assert parse_offsets('{"data":{"0":23,"1":-2}}', "data", EARLIEST) == {0: 23, 1: -2}
    assert kafka_offsets_json({"1": 5, "0": 3}, "data") == '{"data": {"0": 3, "1": 5}}'
    assert kafka_offsets_json("latest", "data") == "latest"
    assert PRODUCER_SETTINGS["kafka.linger.ms"] == "5" and PRODUCER_SETTINGS["kafka.batch.size"] == "16384"


def test_kafka_backend_builds_source_and_sink(spark):
    from pyspark.errors import AnalysisException

    from spoolwire import KafkaTopic

    t = KafkaTopic("data", "broker:9092")
    # no Kafka connector on this classpath: Spark must fail on the data source itself
    with pytest.raises(AnalysisException, match="kafka"):
        read_topic(spark, t, starting={"0": 5})
    with pytest.raises(AnalysisException, match="kafka"):
        publish(records(spark, 3), t)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    n=st.integers(0, 400),
    spark_parts=st.integers(1, 6),
    topic_parts=st.integers(1, 5),
    mode=st.sampled_from(["keyless", "keyed", "partition_by"]),
)
def test_publish_dense_and_complete(spark, n, spark_parts, topic_parts, mode):
    from spoolwire.workspace import scratch_path

    t = FileTopic(scratch_path(spark, "prop-topic"))
    df = spark.range(n, numPartitions=spark_parts).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 5).cast("string").alias("k")
    )
    kw = {"keyless": {}, "keyed": {"key_column": "k"},
          "partition_by": {"partition_by": F.pmod(F.col("id").cast("long") * 7, F.lit(topic_parts)),
                           "order_by": [F.col("id").cast("long")]}}[mode]
    r = publish(df, t, partitions=topic_parts, **kw)
    env = read_topic(spark, t)
    assert r.rows_sent == n
    ok, counts = dense(env)
    assert ok and sum(counts.values()) == n
    ids = sorted(int(json.loads(bytes(v.value).decode())["id"]) for v in env.select("value").collect())
    assert ids == list(range(n))


def test_topic_files_are_bounded(spark, tmp):
    import glob

    t = FileTopic(tmp)
    publish(records(spark, 500, parts=1), t, partitions=1, max_records_per_file=100)
    local = tmp.removeprefix("file:")
    files = glob.glob(f"{local}/partition=0/*.parquet")
    assert len(files) >= 5
    ok, counts = dense(read_topic(spark, t))
    assert ok and counts == {0: 500}
