"""Reports, previews, progress and schema descriptions."""

from pyspark.sql import functions as F

from spoolwire import FileTopic, describe_schema, first_records, preview, progress, publish, read_topic, schema_profile
from spoolwire.operators.records import parse_any


def _topic(spark, tmp):
    t = FileTopic(tmp)
    df = spark.range(2500).select(
        F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.col("id")).alias("ts")
    )
    publish(df, t, columns=["id"], partitions=2, partition_by=F.pmod(F.col("id").cast("long"), F.lit(2)),
            order_by=[F.col("id").cast("long")], timestamp_column="ts")
    return t


def test_progress(spark, tmp):
    env = read_topic(spark, _topic(spark, tmp))
    got = sorted((r.partition, r.line_count, r.rps) for r in progress(env, every=500).collect())
    # partition 0 holds ids 0, 2, 4...: record n arrives 2(n-1) seconds after the first
    assert got[0] == (0, 500, round(500 / 998, 6))
    assert [g[:2] for g in got] == [(0, 500), (0, 1000), (1, 500), (1, 1000)]


def test_first_records_and_preview(spark, tmp):
    env = read_topic(spark, _topic(spark, tmp))
    fr = first_records(env, 3).select("partition", "offset", "record_no").collect()
    assert sorted(map(tuple, fr)) == [(0, 0, 1), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3)]
    assert preview(env).count() == 20
    top = preview(env, 3, order_by=["partition", "offset"]).select("partition", "offset").collect()
    assert [tuple(r) for r in top] == [(0, 0), (0, 1), (0, 2)]


def test_describe_schema(spark):
    df = spark.createDataFrame([], "key string, `年份` string, n int")
    rows = [tuple(r) for r in describe_schema(spark, df).collect()]
    assert rows == [(0, "key", "string", True), (1, "年份", "string", True), (2, "n", "int", True)]


def test_schema_profile(spark, tmp):
    env = parse_any(read_topic(spark, _topic(spark, tmp)))
    got = {r.partition: (r.records, r.json_schema) for r in schema_profile(env).collect()}
    assert got == {0: (1250, "OBJECT<id: STRING>"), 1: (1250, "OBJECT<id: STRING>")}
