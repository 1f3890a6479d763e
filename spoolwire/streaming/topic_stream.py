"""Unbounded topic reads and the continuous decode-and-emit job.

Stateless: every operator used here is a per-record projection, so no state
store is involved; progress lives in the sink's checkpoint folder, which must
be a shared, durable path (a stable one to resume a job).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spoolwire.functions.envelope import ENVELOPE, ENVELOPE_COLUMNS, with_position
from spoolwire.functions.json import parse_json_any, parse_json_struct
from spoolwire.sources.topic import (
    EARLIEST,
    LATEST,
    FileTopic,
    KafkaTopic,
    Topic,
    current_end_offsets,
    kafka_offsets_json,
    offset_predicate,
    offsets_schema,
    parse_offsets,
)
from spoolwire.workspace import path_exists, scratch_path


def _fixed_start(spark: SparkSession, topic: FileTopic, starting, start_store: str | None):
    """``starting`` with every ``latest`` resolved to an offset, once per ``start_store``.

    A restarted stream must skip just the records that its first start
    skipped, so the resolved offsets (one row per partition) are kept and read
    again.
    """
    spec = parse_offsets(starting, topic.name, EARLIEST)
    if spec == EARLIEST or (isinstance(spec, dict) and LATEST not in spec.values()):
        return spec
    if start_store and path_exists(spark, start_store):
        rows = spark.read.schema(offsets_schema()).parquet(start_store).collect()
        return {r.partition: r.end_offset for r in rows}
    ends = current_end_offsets(spark, topic) or {}
    named = dict(ends) if spec == LATEST else {p: ends.get(p, 0) if o == LATEST else o for p, o in spec.items()}
    if start_store:
        spark.createDataFrame(sorted(named.items()), offsets_schema()).coalesce(1).write.parquet(start_store)
    return named


def stream_topic(
    spark: SparkSession,
    topic: Topic,
    starting="earliest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
    start_store: str | None = None,
) -> DataFrame:
    """Unbounded read of a topic as envelope rows (a streaming DataFrame).

    ``starting`` takes the same forms as a bounded read and applies to the
    records present when the stream first starts; later records are always
    read. For a file topic, ``latest`` is resolved when this is called; give a
    ``start_store`` (a folder that belongs to the sink's checkpoint) so that a
    resumed stream starts from the same offsets. Each backend has its own
    bound of a batch: files or offsets.
    """
    if isinstance(topic, KafkaTopic):
        if max_files_per_trigger:
            raise ValueError("max_files_per_trigger bounds file topics; use max_offsets_per_trigger")
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap_servers)
            .option("subscribe", topic.name)
            .option("startingOffsets", kafka_offsets_json(starting, topic.name))
            .option("failOnDataLoss", str(bool(fail_on_data_loss)).lower())
        )
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return reader.options(**topic.options).load()
    if max_offsets_per_trigger:
        raise ValueError("max_offsets_per_trigger bounds Kafka topics; use max_files_per_trigger")
    if fail_on_data_loss:
        raise ValueError("a stream of a file topic can't check for lost records; use check_no_data_loss")
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(topic.path).select(ENVELOPE_COLUMNS)
    pred = offset_predicate(spark, topic, _fixed_start(spark, topic, starting, start_store), "latest")
    return df if pred is None else df.filter(pred)


def decode_records(
    df: DataFrame,
    schema: T.StructType | None = None,
    strict: bool = False,
    deserializer: Callable | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """``partition, offset, key, value`` as text plus the decoded record.

    The record is ``json`` (a ``VARIANT``, schemaless) by default, a struct
    ``record`` of ``schema`` when one is declared, or ``deserializer(value)``.
    ``strict`` fails the query on invalid UTF-8 or malformed JSON;
    ``corrupt_column`` instead adds a column with the text of records that
    can't be decoded (null for the others).
    """
    if strict and corrupt_column:
        raise ValueError("strict decoding fails on malformed records; it has none to put into a corrupt column")
    out = with_position(df, strict=strict)
    mode = "strict" if strict else "permissive"
    if deserializer is not None:
        name, value = "record", deserializer(F.col("value"))
    elif schema is not None:
        name, value = "record", parse_json_struct("value", schema, corrupt_column=corrupt_column, mode=mode)
    else:
        name, value = "json", parse_json_any("value", mode)
    out = out.withColumn(name, value)
    if not corrupt_column:
        return out
    if schema is not None and deserializer is None:
        bad = F.col(f"record.`{corrupt_column}`")
        return out.withColumn(corrupt_column, bad).withColumn("record", F.col("record").dropFields(f"`{corrupt_column}`"))
    lost = F.col(name).isNull() & F.col("value").isNotNull()
    return out.withColumn(corrupt_column, F.when(lost, F.col("value")))


def emit_records(
    df: DataFrame,
    sink: str = "parquet",
    path: str | None = None,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    foreach_batch: Callable | None = None,
    query_name: str | None = None,
    partition_by: str | None = None,
    console_rows: int = 20,
) -> StreamingQuery:
    """Start writing a streaming DataFrame (append mode) and return the query.

    ``parquet`` and ``json`` (lines) need a ``path`` and write every record,
    on the executors, once. ``console`` is a preview: it prints at most
    ``console_rows`` rows of each micro-batch, untruncated. ``memory`` (needs
    ``query_name``) gathers everything on the driver, for tests.
    ``available_now`` drains what is there and stops; otherwise
    ``processing_time`` sets the micro-batch interval.
    """
    spark = df.sparkSession
    cp = checkpoint_location or scratch_path(spark, "stream-checkpoint")
    writer = df.writeStream.outputMode("append").option("checkpointLocation", cp)
    if query_name:
        writer = writer.queryName(query_name)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 second")
    if foreach_batch is not None:
        return writer.foreachBatch(foreach_batch).start()
    if sink == "console":
        return writer.format("console").option("truncate", "false").option("numRows", console_rows).start()
    if sink == "memory":
        return writer.format("memory").start()
    if sink in ("parquet", "json"):
        if not path:
            raise ValueError(f"a {sink} sink needs a path")
        return writer.format(sink).start(path)
    raise ValueError(f"unknown sink {sink!r}")


#: Folder column of :func:`run_stream` with a corrupt column: records that could not be decoded.
QUARANTINED = "quarantined"


def run_stream(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint_location: str | None = None,
    starting="earliest",
    schema: T.StructType | None = None,
    strict: bool = False,
    available_now: bool = True,
    deserializer: Callable | None = None,
    corrupt_column: str | None = None,
    sink: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> StreamingQuery:
    """Continuous per-record decode-and-emit from ``starting``: read, decode, parse, write.

    With ``available_now`` the call returns once every record present at the
    start is written; rerunning with the same checkpoint adds none twice and
    misses none. With a ``corrupt_column``, records that can't be decoded are
    routed apart: the sink has a folder ``quarantined=true`` beside
    ``quarantined=false``. ``max_*_per_trigger`` bound each micro-batch.
    """
    checkpoint = (checkpoint_location or scratch_path(spark, "stream-checkpoint")).rstrip("/")
    stream = stream_topic(
        spark, topic, starting, max_files_per_trigger, max_offsets_per_trigger, start_store=f"{checkpoint}-start"
    )
    decoded = decode_records(stream, schema, strict, deserializer, corrupt_column)
    if corrupt_column:
        decoded = decoded.withColumn(QUARANTINED, F.col(f"`{corrupt_column}`").isNotNull())
    q = emit_records(
        decoded, sink, path, checkpoint, available_now=available_now, partition_by=QUARANTINED if corrupt_column else None
    )
    if available_now:
        q.awaitTermination()
    return q


def stream_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Live progress of a running stream, one row per recent micro-batch:
    ``batch_id, input_rows, input_rows_per_second, processed_rows_per_second``.

    Read from the query's own progress reports (kept by Spark on the driver,
    a bounded window of recent batches), not from the data.
    """

    def field(p, name, default):
        value = getattr(p, name, None)
        if value is None and isinstance(p, dict):
            value = p.get(name)
        return default if value is None else value

    rows = [
        (
            int(field(p, "batchId", -1)),
            int(field(p, "numInputRows", 0)),
            float(field(p, "inputRowsPerSecond", 0.0)),
            float(field(p, "processedRowsPerSecond", 0.0)),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(
        rows,
        "batch_id long, input_rows long, input_rows_per_second double, processed_rows_per_second double",
    )


__all__ = ["FileTopic", "decode_records", "emit_records", "run_stream", "stream_progress", "stream_topic"]
