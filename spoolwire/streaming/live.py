"""Streams that keep tables of figures as they run, every batch exactly once.

Each micro-batch writes a folder named by its number. A batch that runs again,
because the job failed between the write and the commit of its checkpoint,
replaces its own folder, so no row is there twice and none is missing. What a
batch needs to know of the ones before it is the folder of its predecessor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoolwire.operators.report import BUCKET, bucket_counts, gaps_between, numbered_records
from spoolwire.sources.topic import Topic
from spoolwire.streaming.topic_stream import emit_records, stream_topic
from spoolwire.workspace import path_exists

#: Folder column of the batches.
BATCH = "batch_id"


def batch_path(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={batch}"


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Put the rows of a batch into its folder, in place of what an earlier run of the batch left there."""
    df.write.mode("overwrite").parquet(batch_path(path, batch))


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreach_batch`` function that writes every batch, ``transform``-ed, to ``path`` once, however often it runs."""

    def write(batch: DataFrame, number: int) -> None:
        write_batch(transform(batch) if transform else batch, path, number)

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows that a :func:`batch_writer` has written, with ``batch_id``."""
    return spark.read.parquet(path).withColumn(BATCH, F.col(BATCH).cast("long"))


def _finished(query: StreamingQuery, available_now: bool) -> StreamingQuery:
    if available_now:
        query.awaitTermination()
    return query


def live_progress(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint_location: str,
    every: int = 1000,
    available_now: bool = True,
    bucket: int = BUCKET,
    **stream_options,
) -> StreamingQuery:
    """Progress of each topic partition while records come in: :func:`read_progress` gives the rows.

    Records are numbered in the order of batches, and of offsets in a batch;
    numbers go on where the batch before ended, also after a restart with the
    same checkpoint. A batch keeps one row per partition (its records so far
    and their earliest timestamp). With ``available_now`` the call returns once
    what is there has been read.
    """

    def batch(rows: DataFrame, number: int) -> None:
        figures(rows.select("partition", "offset", "timestamp"), number)

    def figures(rows: DataFrame, number: int) -> None:
        so_far = f"{path}/so_far"
        if number:
            if not path_exists(spark, batch_path(so_far, number - 1)):
                raise ValueError(f"{path} has no figures of batch {number - 1}: the checkpoint belongs to another table")
            old = spark.read.parquet(batch_path(so_far, number - 1))
        else:
            old = spark.createDataFrame([], "partition int, records long, us0 long")
        buckets = bucket_counts(rows, bucket)
        new = buckets.groupBy("partition").agg(F.sum("_n").alias("records"), F.min("_us0").alias("us0"))
        both = old.unionByName(new).groupBy("partition").agg(F.sum("records").alias("records"), F.min("us0").alias("us0"))
        old = old.select("partition", F.col("records").alias("_old"), F.col("us0").alias("_old_us"))
        buckets = buckets.join(old, "partition", "left").select(
            "partition", "_b", "_n", "_lo", "_hi",
            (F.col("_before") + F.coalesce("_old", F.lit(0))).alias("_before"), F.least("_us0", "_old_us").alias("_us0"),
        )
        marked = buckets.where(f"(_before + _n) div {int(every)} > _before div {int(every)}")
        marks = numbered_records(rows, marked, lambda no: no % every == 0, bucket)
        elapsed = F.unix_micros("timestamp") - F.col("_us0")
        rate = F.round(F.col("record_no") * F.lit(1_000_000.0) / F.nullif(elapsed, F.lit(0)), 6)
        write_batch(marks.select("partition", F.col("record_no").alias("line_count"), rate.alias("rps")), f"{path}/progress", number)
        write_batch(both, so_far, number)

    stream = stream_topic(spark, topic, **stream_options)
    return _finished(emit_records(stream, checkpoint_location=checkpoint_location, available_now=available_now, foreach_batch=batch), available_now)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, partition, line_count, rps`` of every mark that a :func:`live_progress` stream has passed."""
    return read_batches(spark, f"{path}/progress")


def watch_offsets(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint_location: str,
    available_now: bool = True,
    bucket: int = BUCKET,
    **stream_options,
) -> StreamingQuery:
    """Keep count, first and last offset of every bucket of ``bucket`` offsets, as records come in.

    A stateful aggregate in update mode, for file topics and Kafka alike: the
    state store holds one small row per partition and bucket, and a batch
    writes the buckets that it changed. :func:`seen_gaps` reads holes from them.
    """
    buckets = stream_topic(spark, topic, **stream_options).groupBy("partition", F.expr(f"offset div {int(bucket)}").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("offset").alias("_lo"), F.max("offset").alias("_hi")
    )
    writer = buckets.writeStream.outputMode("update").option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
    return _finished(writer.foreachBatch(batch_writer(path)).start(), available_now)


def seen_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every bucket that a :func:`watch_offsets` stream has written: ``partition, _b, _n, _lo, _hi``."""
    last = F.max_by(F.struct("_n", "_lo", "_hi"), BATCH)
    return read_batches(spark, path).groupBy("partition", "_b").agg(last.alias("s")).select("partition", "_b", "s.*")


def seen_gaps(spark: SparkSession, path: str, topic_df: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The holes (as of ``offset_gaps``) among the records that a :func:`watch_offsets` stream has seen.

    Buckets without holes, and the holes between buckets, come from the
    stream's table alone; of ``topic_df`` only damaged buckets are read.
    """
    return gaps_between(topic_df, seen_buckets(spark, path), bucket)


def drop_resent(stream: DataFrame, delay: str, by: Sequence[str] | None = None) -> DataFrame:
    """An envelope stream without records that a producer sent again within ``delay`` of event time.

    Records are the same if their key, value and timestamp are, whatever their
    offsets; or, with ``by``, if these columns are. The first to arrive stays.
    The state holds a digest per record, for ``delay`` after its timestamp.
    ``delay`` must cover how late a record can come: Spark drops records
    further behind the newest timestamp, as it no longer knows their equals,
    and those from 1970 or before, where its watermark starts.
    """
    marked = stream.withWatermark("timestamp", delay)
    if by is not None:
        return marked.dropDuplicatesWithinWatermark(list(by))
    digest = F.sha2(F.concat(F.coalesce(F.sha2("key", 256), F.lit("-")), F.coalesce(F.sha2("value", 256), F.lit("-"))), 256)
    return marked.withColumn("_digest", digest).dropDuplicatesWithinWatermark(["_digest", "timestamp"]).drop("_digest")
