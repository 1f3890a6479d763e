"""Topics: a named, partitioned, append-only log of envelope rows.

Two backends share one envelope schema:

* :class:`KafkaTopic` passes options through to Spark's Kafka source and sink
  (needs the ``spark-sql-kafka`` package on the classpath);
* :class:`FileTopic` keeps the log as Parquet under a shared folder,
  directory-partitioned by ``partition`` and sorted by ``offset`` within each
  file, so partition and offset predicates prune directories and row groups.

Offsets use Kafka's conventions: ``'earliest'`` / ``'latest'`` or JSON such as
``{"data": {"0": 100, "1": -2}}`` where ``-2`` means earliest and ``-1``
latest; ending offsets are exclusive.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwire.errors import DataLossError
from spoolwire.functions.envelope import ENVELOPE, ENVELOPE_COLUMNS
from spoolwire.workspace import path_exists

EARLIEST = -2
LATEST = -1

_ENDS = "_end_offsets"


@dataclass(frozen=True)
class FileTopic:
    """A topic kept as Parquet files below ``path`` (a shared, durable folder)."""

    path: str
    name: str = "data"

    @property
    def ends_path(self) -> str:
        return f"{self.path}/{_ENDS}"


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic; ``options`` are extra ``kafka.*`` or source/sink options."""

    name: str
    bootstrap_servers: str
    options: dict = field(default_factory=dict)


Topic = FileTopic | KafkaTopic


def current_end_offsets(spark: SparkSession, topic: FileTopic) -> dict[int, int] | None:
    """``{partition: end_offset}`` for every partition, or None if the topic does not exist.

    The end-offset log is also the topic's metadata: it holds a row for every
    partition from creation on. One row per partition comes back to the driver.
    """
    if not path_exists(spark, topic.ends_path):
        return None
    ends = spark.read.schema(offsets_schema()).parquet(topic.ends_path)
    rows = ends.groupBy("partition").agg(F.max("end_offset").alias("end_offset")).collect()
    return {r.partition: r.end_offset for r in rows}


def ends_in_data(spark: SparkSession, topic: FileTopic, ends: dict[int, int]) -> dict[int, int]:
    """The ends of those partitions that hold records at or beyond ``ends``.

    The bound reaches the scan, where row groups of earlier records are skipped.
    """
    if not path_exists(spark, topic.path):
        return {}
    rows = spark.read.schema(ENVELOPE).parquet(topic.path).filter(
        _per_partition(ends, lambda o: F.col("offset") >= F.lit(o), default=F.lit(True))
    )
    return {r.partition: r.hi + 1 for r in rows.groupBy("partition").agg(F.max("offset").alias("hi")).collect()}


def topic_partitions(spark: SparkSession, topic: FileTopic) -> int | None:
    """Partition count of the topic, or None if it does not exist."""
    ends = current_end_offsets(spark, topic)
    return None if ends is None else len(ends)


def record_end_offsets(spark: SparkSession, topic: FileTopic, ends: dict[int, int]) -> None:
    """Append ``(partition, end_offset)`` rows to the topic's end-offset log (one small file)."""
    rows = [(int(p), int(o)) for p, o in sorted(ends.items())]
    spark.createDataFrame(rows, offsets_schema()).coalesce(1).write.mode("append").parquet(topic.ends_path)


def create_topic(spark: SparkSession, topic: FileTopic, partitions: int = 1) -> FileTopic:
    """Create an empty topic with ``partitions`` partitions (idempotent for the same count)."""
    if partitions < 1:
        raise ValueError("a topic needs at least one partition")
    current = topic_partitions(spark, topic)
    if current is not None:
        if current != partitions:
            raise ValueError(f"topic {topic.name} has {current} partitions, not {partitions}")
        return topic
    record_end_offsets(spark, topic, {p: 0 for p in range(partitions)})
    return topic


def end_offsets(spark: SparkSession, topic: FileTopic) -> DataFrame:
    """``partition, end_offset`` (the next offset to be written), one row per partition."""
    ends = current_end_offsets(spark, topic) or {}
    return spark.createDataFrame(sorted(ends.items()), offsets_schema())


def parse_offsets(spec, topic_name: str, default: int) -> dict[int, int] | int:
    """Normalise an offsets option to ``EARLIEST``/``LATEST`` or ``{partition: offset}``."""
    if isinstance(spec, int):
        return spec
    if isinstance(spec, str):
        word = spec.strip().lower()
        if word == "earliest":
            return EARLIEST
        if word == "latest":
            return LATEST
        spec = json.loads(spec)
    if isinstance(spec, dict):
        if topic_name in spec and isinstance(spec[topic_name], dict):
            spec = spec[topic_name]
        return {int(p): int(o) for p, o in spec.items()}
    if spec is None:
        return default
    raise ValueError(f"cannot read offsets from {spec!r}")


def kafka_offsets_json(spec, topic_name: str) -> str:
    """The ``startingOffsets``/``endingOffsets`` string Spark's Kafka source expects."""
    parsed = parse_offsets(spec, topic_name, EARLIEST)
    if parsed == EARLIEST:
        return "earliest"
    if parsed == LATEST:
        return "latest"
    return json.dumps({topic_name: {str(p): o for p, o in sorted(parsed.items())}})


def _latest_map(spark: SparkSession, topic: FileTopic) -> dict[int, int]:
    return current_end_offsets(spark, topic) or {}


def offset_predicate(spark: SparkSession, topic: FileTopic, starting, ending) -> Column | None:
    """Row predicate for the requested ``[starting, ending)`` range, or None for everything.

    Expressed on ``partition`` and ``offset`` only, so Spark prunes partition
    directories and pushes the offset bounds into the Parquet scan.
    """
    start = parse_offsets(starting, topic.name, EARLIEST)
    end = parse_offsets(ending, topic.name, LATEST)
    latest = None
    if start == LATEST or end == EARLIEST or (isinstance(start, dict) and LATEST in start.values()):
        latest = _latest_map(spark, topic)
    if end == EARLIEST or (isinstance(end, dict) and EARLIEST in end.values()):
        raise ValueError("ending offsets cannot be 'earliest'")

    def bounds_for(spec, is_start):
        if spec == EARLIEST and is_start:
            return None
        if spec == LATEST and not is_start:
            return None
        if spec == LATEST:
            return {p: o for p, o in latest.items()}
        out = {}
        for p, o in spec.items():
            if is_start and o == EARLIEST:
                continue
            if not is_start and o == LATEST:
                continue
            out[p] = latest.get(p, 0) if o == LATEST else o
        return out

    lo = bounds_for(start, True)
    hi = bounds_for(end, False)
    conds = []
    if lo:
        # partitions not named (or never written) keep every offset
        conds.append(_per_partition(lo, lambda o: F.col("offset") >= F.lit(o), default=F.lit(True)))
    if hi:
        conds.append(_per_partition(hi, lambda o: F.col("offset") < F.lit(o), default=F.lit(True)))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def by_partition(values: dict[int, int]) -> Column:
    """The value of a row's ``partition`` (null for one without), looked up in a literal array: no join, no shuffle."""
    slots = [F.lit(values.get(p)).cast("long") for p in range(max(values, default=-1) + 1)]
    return F.get(F.array(*slots), F.col("partition")) if slots else F.lit(None).cast("long")


def _per_partition(bounds: dict[int, int], make, default: Column) -> Column:
    """``(partition = p AND bound_p) OR ... OR partition NOT IN (...)`` (prunable form)."""
    parts = sorted(bounds)
    cond = None
    for p in parts:
        term = (F.col("partition") == F.lit(p)) & make(bounds[p])
        cond = term if cond is None else cond | term
    rest = ~F.col("partition").isin(parts) & default
    return cond | rest


def _empty_envelope(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ENVELOPE)


def read_topic(
    spark: SparkSession,
    topic: Topic,
    starting="earliest",
    ending="latest",
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Bounded read of a topic as envelope rows.

    ``fail_on_data_loss`` makes the call fail when offsets of the range that
    were recorded are missing (a head, holes, a tail, a whole partition); off,
    missing records are skipped silently, and :func:`missing_ranges` lists them.
    """
    if isinstance(topic, KafkaTopic):
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap_servers)
            .option("subscribe", topic.name)
            .option("startingOffsets", kafka_offsets_json(starting, topic.name))
            .option("endingOffsets", kafka_offsets_json(ending, topic.name))
            .option("failOnDataLoss", str(bool(fail_on_data_loss)).lower())
            .options(**topic.options)
            .load()
        )
    if parse_offsets(starting, topic.name, EARLIEST) == LATEST:
        raise ValueError("starting offsets cannot be 'latest' for a bounded read")
    if not path_exists(spark, topic.path):
        return _empty_envelope(spark)
    df = spark.read.schema(ENVELOPE).parquet(topic.path).select(ENVELOPE_COLUMNS)
    pred = offset_predicate(spark, topic, starting, ending)
    if pred is not None:
        df = df.filter(pred)
    if fail_on_data_loss:
        check_no_data_loss(spark, topic, starting, ending)
    return df


def expected_ranges(spark: SparkSession, topic: FileTopic, starting="earliest", ending="latest") -> dict[int, tuple[int, int]]:
    """``{partition: (lo, hi)}``: the offsets a range should hold, by the recorded ends (``hi`` exclusive).

    ``earliest`` is offset 0, as file topics drop nothing.
    """
    latest, first = _latest_map(spark, topic), {}
    if not latest and path_exists(spark, topic.path):  # records without a log: their own ends are all there is
        rows = spark.read.schema(ENVELOPE).parquet(topic.path).groupBy("partition")
        found = rows.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()
        latest, first = {r.partition: r.hi + 1 for r in found}, {r.partition: r.lo for r in found}
    start, end = parse_offsets(starting, topic.name, EARLIEST), parse_offsets(ending, topic.name, LATEST)

    def bound(spec, p: int, default: int) -> int:
        o = spec.get(p, default) if isinstance(spec, dict) else spec
        return first.get(p, 0) if o == EARLIEST else latest[p] if o == LATEST else min(o, latest[p])

    ranges = {p: (bound(start, p, EARLIEST), bound(end, p, LATEST)) for p in sorted(latest)}
    return {p: (lo, hi) for p, (lo, hi) in ranges.items() if lo < hi}


def missing_ranges(spark: SparkSession, topic: FileTopic, starting="earliest", ending="latest") -> DataFrame:
    """``partition, first_missing, end_missing, missing``: offsets that were recorded, but are not there.

    Lost heads, holes, tails and whole partitions, by the recorded ends.
    """
    from spoolwire.operators.report import offset_gaps

    expected = expected_ranges(spark, topic, starting, ending)
    if path_exists(spark, topic.path):
        rows = spark.read.schema(ENVELOPE).parquet(topic.path).select("partition", "offset")
    else:
        rows = spark.createDataFrame([], "partition int, offset long")
    lo, hi = (by_partition({p: r[i] for p, r in expected.items()}) for i in (0, 1))
    present = rows.where((F.col("offset") >= lo) & (F.col("offset") < hi))
    # the offsets just outside of each range hold its ends
    edges = [(p, o) for p, (a, b) in expected.items() for o in (a - 1, b)]
    gaps = offset_gaps(present.unionByName(spark.createDataFrame(edges, "partition int, offset long")))
    return gaps.select("partition", (F.col("offset") + 1).alias("first_missing"), F.col("next_offset").alias("end_missing"), "missing")


def check_no_data_loss(spark: SparkSession, topic: FileTopic, starting="earliest", ending="latest") -> None:
    """Raise :class:`DataLossError` if offsets of the range are missing (an action)."""
    lost = missing_ranges(spark, topic, starting, ending)
    total = lost.agg(F.count(F.lit(1)).alias("ranges"), F.sum("missing").alias("offsets")).first()
    if total.ranges:
        first = lost.orderBy("partition", "first_missing").limit(10).collect()
        said = "; ".join(f"partition {r.partition}: {r.first_missing}..{r.end_missing - 1}" for r in first)
        raise DataLossError(f"{total.offsets} offsets missing in {total.ranges} ranges, first: {said}")


def offsets_schema() -> T.StructType:
    return T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("end_offset", T.LongType())])
