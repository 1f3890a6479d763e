"""Plan shape: no Python on the row path, pruning and pushdown reach the scans."""

from pyspark.sql import functions as F

from spoolwire import FileTopic, parse_records, publish, read_topic, string_schema
from spoolwire.plans.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_registered_queries(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in p, (name, marker)


def test_from_json_schema_narrowed(spark, tmp):
    t = FileTopic(tmp)
    publish(spark.range(10).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b")), t)
    parsed = parse_records(read_topic(spark, t), string_schema(["a", "b"])).select("a")
    p = plan(parsed)
    assert "from_json" in p and "b:" not in p.split("from_json")[1].split(")")[0]


def test_topic_scan_prunes_columns_and_partitions(spark, tmp):
    t = FileTopic(tmp)
    publish(spark.range(30).select(F.col("id").cast("string").alias("a")), t, partitions=3)
    df = read_topic(spark, t, starting={"1": 2}).filter("partition = 1").select("offset")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(partition" in p
    assert "ReadSchema: struct<offset:bigint>" in p


def _topic(spark, tmp, n=600, parts=3):
    t = FileTopic(tmp)
    publish(spark.range(n).select("id", F.col("id").cast("string").alias("a"), F.timestamp_seconds("id").alias("ts")),
            t, columns=["a"], partitions=parts, partition_by=F.pmod(F.col("id"), F.lit(parts)),
            order_by=[F.col("id")], timestamp_column="ts")
    return read_topic(spark, t)


def test_first_records_bound_reaches_scan(spark, tmp):
    from spoolwire import first_records

    p = plan(first_records(_topic(spark, tmp), 5))
    filters = [part.split("Format:")[0] for part in p.split("DataFilters:")[1:]]
    assert any("offset" in f and "ubquery" in f for f in filters), p  # the largest start bounds the scan


def test_reports_run_no_job_when_built(spark, tmp):
    import inspect

    from spoolwire.operators import report

    assert "collect(" not in inspect.getsource(report)


def test_offset_gaps_windows_are_bucketed(spark, tmp):
    from spoolwire import offset_gaps

    p = plan(offset_gaps(_topic(spark, tmp)))
    # the row-level window is partitioned by (partition, bucket), never by partition alone
    windows = [line for line in p.splitlines() if "Window [lead(offset" in line]
    assert windows and all("_b" in w.split("windowspecdefinition(")[1] for w in windows)


def test_stored_variant_is_read_by_field(spark):
    p = plan(QUERIES["variant_fields"](spark, SMALL).select("event_type", "user_id"))
    # the scan asks for two fields of the stored value, not for the value
    assert "ReadSchema: struct<json:struct<0:string,1:string>>" in p, p
