"""Publishing records to a topic (the producer side).

Kafka backend: ``write.format('kafka')``; the broker assigns offsets.

File backend: offsets are dense per partition.

* Keyless records are written where they are read, without a shuffle: counts
  per split (a narrow pass) and their running sums number the records in
  source order, and each partition takes an even range of the numbers. So
  every split is a writer, whatever the number of partitions, and a
  partition's offsets follow the source. Records that don't come straight from
  files are staged in the shared folder first.
* Keyed, placed and ordered records are range-partitioned by ``(partition,
  order_by..., hash(value))``, so a partition that holds a large share of the
  rows is split across tasks. They are staged once in the shared folder,
  tagged with the task that wrote them and a place in it; a count per
  ``(partition, task)`` and its running sum give each run its first offset.
  The stage is deleted after the commit.

The ends are recorded after the data is committed. A publish that broke off in
between has left records beyond the recorded ends; the next one starts behind
them, so no offset is used twice. A file topic takes one publisher at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from spoolwire.functions.envelope import CREATE_TIME, ENVELOPE, Serializer, wire_value
from spoolwire.operators.source_order import BROADCAST_SPLITS, numbered, split_starts, split_sums
from spoolwire.sources.csv import BLOCK, FILE
from spoolwire.sources.topic import KafkaTopic, Topic, by_partition, current_end_offsets, ends_in_data, record_end_offsets
from spoolwire.workspace import delete_path, scratch_path

# The producer settings of the source application
# (retries, linger, batch size, largest request, request timeout).
PRODUCER_SETTINGS = {
    "kafka.retries": "3",
    "kafka.linger.ms": "5",
    "kafka.batch.size": "16384",
    "kafka.max.request.size": "10485760",
    "kafka.request.timeout.ms": "30000",
}


@dataclass(frozen=True)
class PublishResult:
    """``starts``: the first offset of each partition that this publish could use (file topics)."""

    topic: str
    rows_sent: int
    partitions: int
    starts: dict[int, int] = field(default_factory=dict)


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def _counted(df: DataFrame, observation: Observation | None, long_rows: Column) -> DataFrame:
    if observation is None:
        return df
    kept = F.col("_keep")
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(kept).alias("rows_sent"),
        F.count_if(~kept).alias("rows_skipped"),
        F.count_if(long_rows & kept).alias("rows_long"),
    )


def publish(
    df: DataFrame,
    topic: Topic,
    *,
    columns: Sequence[str] | None = None,
    optional_columns: Sequence[str] = (),
    key_column: str | None = None,
    serializer: Serializer | None = None,
    partitions: int | None = None,
    partition_by: Column | None = None,
    order_by: Sequence[str | Column] | None = None,
    timestamp_column: Column | str | None = None,
    wire: bool = False,
    keep: Column | None = None,
    observation: Observation | None = None,
    max_records_per_file: int = 5_000_000,
    in_source_order: bool = False,
    splits: DataFrame | None = None,
) -> PublishResult:
    """Append ``df``'s records to ``topic``.

    Records become JSON (or ``serializer(struct)``) bytes in ``value``;
    ``optional_columns`` are part of a record only where they aren't null;
    ``key`` is null unless ``key_column`` is set. With ``wire=True`` ``df``
    already has ``key`` and ``value``.

    Placement: ``partition_by`` (a column giving the partition number) wins;
    else the key's hash, or for records with a null key the value's; without
    either, records are dealt evenly over the partitions. ``order_by`` fixes
    the offset order within each partition; without it offsets follow an
    arbitrary order. ``timestamp_column`` sets the record timestamp (default:
    the write time).

    ``keep`` sends only the rows it holds true for; ``observation`` (an
    ``Observation``) is filled with ``rows_in, rows_sent, rows_skipped,
    rows_long`` (sent rows with an optional column). The counts are taken
    where each row passes exactly once: in the writing pass, and after a range
    shuffle, whose sampling job would otherwise count rows a second time.
    Topic files hold at most ``max_records_per_file`` records each. With
    ``in_source_order``, ``splits`` can give the ``split_sums`` of the kept rows, where
    another pass has counted them; if what is written isn't what they count, the
    publish fails.
    """
    extra = [_col(c).alias(f"_o{i}") for i, c in enumerate(order_by or [])]
    ts = _col(timestamp_column).cast("timestamp") if timestamp_column is not None else F.current_timestamp()
    if wire:
        key, value = F.col("key").cast("binary"), F.col("value").cast("binary")
    else:
        cols = list(columns) if columns is not None else [c for c in df.columns if c not in optional_columns]
        key = _col(key_column).cast("string").cast("binary") if key_column else F.lit(None).cast("binary")
        value = wire_value(cols, serializer, optional_columns)
    long_row = F.lit(False)
    for c in optional_columns:
        long_row = long_row | _col(c).isNotNull()
    flags = [(keep if keep is not None else F.lit(True)).alias("_keep"), long_row.alias("_long")]
    if isinstance(topic, KafkaTopic):
        unused = {"order_by": order_by, "timestamp_column": timestamp_column, "partitions": partitions}
        if given := [k for k, v in unused.items() if v is not None]:
            raise ValueError(f"a Kafka topic doesn't take {', '.join(given)}: the broker decides")
        return _publish_kafka(df, key, value, flags, topic, partition_by, observation)

    spark = df.sparkSession
    current = current_end_offsets(spark, topic)
    if current is None:
        n_parts = partitions or 1
        current = {p: 0 for p in range(n_parts)}
    else:
        n_parts = len(current)
        if partitions is not None and partitions != n_parts:
            raise ValueError(f"topic {topic.name} has {n_parts} partitions, not {partitions}")
        current = {**current, **ends_in_data(spark, topic, current)}  # of a publish that broke off
    part_expr = partition_by
    if part_expr is None and key_column is not None:
        # Spark's Murmur3 hash of the key (a Kafka client uses murmur2).
        part_expr = F.pmod(F.when(key.isNull(), F.hash(value)).otherwise(F.hash(_col(key_column).cast("string"))), F.lit(n_parts))
    if in_source_order and (part_expr is not None or order_by):
        raise ValueError("in_source_order is an order of its own: it takes no key, partition_by or order_by")

    sel = [key.alias("key"), value.alias("value"), ts.alias("timestamp")]
    if part_expr is None and order_by:
        part_expr = F.pmod(F.hash(value), F.lit(n_parts))
    if part_expr is not None:
        sel.append(part_expr.cast("int").alias("partition"))
    prepared = df.select(*sel, *extra, *flags)
    stage_path = scratch_path(spark, f"stage-{topic.name}")
    try:
        if part_expr is not None:
            _publish_placed(prepared, observation, by_partition(current), len(extra), n_parts, topic, stage_path, max_records_per_file)
            new_ends = {**current, **ends_in_data(spark, topic, current)}
        elif in_source_order:
            source = df.select(*sel, *extra, *flags, FILE, BLOCK)
            new_ends = _publish_in_order(source, observation, current, topic, stage_path, max_records_per_file, splits)
        else:
            kept = _counted(prepared, observation, F.col("_long")).filter(F.col("_keep"))
            kept.drop("_keep", "_long").write.parquet(f"{stage_path}/records")
            staged = spark.read.schema(kept.drop("_keep", "_long").schema).parquet(f"{stage_path}/records")
            at = {FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start")}
            source = staged.withColumns({**at, "_keep": F.lit(True), "_long": F.lit(False)})
            new_ends = _publish_in_order(source, None, current, topic, stage_path, max_records_per_file)
    finally:
        delete_path(spark, stage_path)
    record_end_offsets(spark, topic, new_ends)
    return PublishResult(topic.name, sum(new_ends.values()) - sum(current.values()), n_parts, current)


def _publish_in_order(source, observation, current, topic, stage_path, max_records_per_file, splits=None) -> dict[int, int]:
    """Kept records of a scan, written by the tasks that read them; the new end of each partition.

    The table of splits (one small row each), unless given, is written beside
    the stage, so that its scan runs once.
    """
    spark = source.sparkSession
    sums = splits
    if sums is None:
        path = f"{stage_path}/splits"
        found = split_sums(source, F.col("_keep"))
        found.write.parquet(path)
        sums = spark.read.schema(found.schema).parquet(path)
    total = sums.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("splits")).first()
    n_parts, n = len(current), total.n or 0
    size, rest = divmod(n, n_parts)  # records of each partition; the first ``rest`` ones get one more
    sent = observation if splits is None or observation is not None else Observation("sent")
    kept = numbered(_counted(source, sent, F.col("_long")), split_starts(sums), F.col("_keep"), total.splits <= BROADCAST_SPLITS)
    at = F.col("record_no") - 1
    longer = rest * (size + 1)
    part = F.expr(f"cast(if(record_no <= {longer}, (record_no - 1) div {size + 1}, {rest} + (record_no - 1 - {longer}) div {max(size, 1)}) as int)")
    begin = F.col("partition").cast("long") * size + F.least(F.col("partition"), F.lit(rest))
    out = kept.withColumn("partition", part).withColumn("offset", by_partition(current) + at - begin)
    _append(out.sortWithinPartitions("partition", "offset"), topic, max_records_per_file)
    if splits is not None and sent.get["rows_sent"] != n:
        raise RuntimeError(f"{sent.get['rows_sent']} records written where {n} were counted: the source changed between two passes over it")
    return {p: o + size + (p < rest) for p, o in current.items()}


def _publish_placed(prepared, observation, end, n_order, n_parts, topic, stage_path, max_records_per_file) -> None:
    """Records with a ``partition``: range shuffle, stage, number, write."""
    spark = prepared.sparkSession
    keys = ["partition", *[f"_o{i}" for i in range(n_order)], "_tie"]
    prepared = prepared.withColumn("_tie", F.xxhash64("value")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    prepared = _counted(prepared, observation, F.col("_long")).filter(F.col("_keep"))
    outside = (F.col("partition") < 0) | (F.col("partition") >= n_parts) | F.col("partition").isNull()
    prepared = prepared.select(
        "key", "value", "timestamp", F.when(outside, F.lit(-1)).otherwise(F.col("partition")).alias("partition"),
        F.spark_partition_id().alias("_seg"), F.monotonically_increasing_id().alias("_row"),
    )
    prepared.write.parquet(stage_path)
    staged = spark.read.schema(prepared.schema).parquet(stage_path)
    if staged.filter(F.col("partition") < 0).limit(1).count():
        raise ValueError(f"partition_by produced a partition outside 0..{n_parts - 1}")
    # one row per (partition, task): a running sum over the tasks of a partition
    w = Window.partitionBy("partition").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged.groupBy("partition", "_seg").agg(F.min("_row").alias("_row0"), F.count(F.lit(1)).alias("_n"))
    runs = runs.withColumn("_base", end + F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = staged.join(runs.select("partition", "_seg", "_row0", "_base"), ["partition", "_seg"])
    out = out.withColumn("offset", F.col("_base") + F.col("_row") - F.col("_row0"))
    _append(out.sortWithinPartitions("partition", "offset"), topic, max_records_per_file)


def _append(out: DataFrame, topic, max_records_per_file: int) -> None:
    out = out.withColumns({"topic": F.lit(topic.name), "timestampType": F.lit(CREATE_TIME)}).select(ENVELOPE.fieldNames())
    out.write.mode("append").option("maxRecordsPerFile", max_records_per_file).partitionBy("partition").parquet(topic.path)


def _publish_kafka(df, key, value, flags, topic: KafkaTopic, part_expr, observation) -> PublishResult:
    sel = [key.alias("key"), value.alias("value")]
    if part_expr is not None:
        sel.append(part_expr.cast("int").alias("partition"))
    obs = observation or Observation("publish")
    out = _counted(df.select(*sel, *flags), obs, F.col("_long")).filter(F.col("_keep")).drop("_keep", "_long")
    writer = out.write.format("kafka").option("kafka.bootstrap.servers", topic.bootstrap_servers)
    writer = writer.option("topic", topic.name).options(**PRODUCER_SETTINGS).options(**topic.options)
    writer.save()
    return PublishResult(topic.name, int(obs.get["rows_sent"]), -1)
