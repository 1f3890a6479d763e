"""Counts, load reports, progress, previews and schema descriptions.

Records of a topic partition are numbered without assuming that offsets are
dense, and without a window over a whole partition: offsets are cut into
buckets, counts per bucket are summed up over the buckets before it, and only
buckets that hold a wanted record and have holes are ordered inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def load_report(df: DataFrame, keep: Column, source: str, topic: str) -> DataFrame:
    """One row: ``source, topic, rows_in, rows_sent, rows_skipped, status``.

    ``keep`` is the predicate deciding which records are sent (see
    ``non_empty``). A single aggregate pass.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(keep).alias("rows_sent"),
        F.count_if(~keep).alias("rows_skipped"),
    ).select(
        F.lit(source).alias("source"),
        F.lit(topic).alias("topic"),
        "rows_in",
        "rows_sent",
        "rows_skipped",
        F.lit("ok").alias("status"),
    )


def observe_counts(df: DataFrame, keep: Column, name: str = "load") -> tuple[DataFrame, Observation]:
    """Attach the load counts to ``df`` as an observation, filled by the action that runs it.

    Only valid where each row is evaluated once: upstream of a range shuffle
    the partitioner's sampling job would count rows again. ``publish`` takes
    ``keep=``/``observation=`` and observes after its shuffle.
    """
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(keep).alias("rows_sent"),
        F.count_if(~keep).alias("rows_skipped"),
    )
    return observed, obs


#: Offsets of a bucket: the most rows that are ever ordered as one group.
BUCKET = 1 << 20


def bucket_counts(topic_df: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per topic partition and bucket of offsets: where it starts, and what lies before it.

    ``partition, _b, _n`` (records), ``_lo, _hi`` (first and last offset),
    ``_before`` (records of the partition's earlier buckets), ``_us0`` (its
    earliest timestamp in microseconds). Aggregated before the shuffle, so the
    windows run over one row per bucket.
    """
    found = topic_df.groupBy("partition", F.expr(f"offset div {int(bucket)}").alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("offset").alias("_lo"), F.max("offset").alias("_hi"),
        F.min(F.unix_micros("timestamp")).alias("_us"),
    )
    whole = Window.partitionBy("partition")
    earlier = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    return found.select("*", before.alias("_before"), F.min("_us").over(whole).alias("_us0")).drop("_us")


def numbered_records(rows: DataFrame, buckets: DataFrame, wanted, bucket: int, most: int | None = None) -> DataFrame:
    """``rows`` that lie in ``buckets`` and whose number in the partition, ``record_no``, is ``wanted``.

    Without holes in a bucket the number follows from the offset, and unwanted
    rows are gone before any is ordered. ``most`` bounds the wanted numbers.
    """
    rows = rows.withColumn("_b", F.expr(f"offset div {int(bucket)}")).join(buckets, ["partition", "_b"])
    dense = F.col("_n") == F.col("_hi") - F.col("_lo") + 1
    at = F.col("_before") + F.col("offset") - F.col("_lo") + 1
    rows = rows.where(~dense | wanted(at))
    place = F.row_number().over(Window.partitionBy("partition", "_b").orderBy("offset"))
    rows = rows.withColumn("_place", place)
    if most is not None:
        rows = rows.where(F.col("_place") <= most)  # a top-k of each group
    no = F.when(dense, at).otherwise(F.col("_before") + F.col("_place"))
    rows = rows.withColumn("record_no", no).where(wanted(F.col("record_no")))
    return rows.drop("_b", "_n", "_lo", "_hi", "_before", "_place")


def progress(topic_df: DataFrame, every: int = 1000, bucket: int = BUCKET) -> DataFrame:
    """Every ``every`` records of each topic partition: running count and records per second.

    ``line_count`` counts the partition's records, in the order of their
    offsets, which may have holes; ``rps`` is ``line_count`` over the seconds
    since the partition's earliest timestamp (null when no time has passed),
    rounded to 6 places.
    """
    rows = topic_df.select("partition", "offset", "timestamp")
    marked = bucket_counts(rows, bucket).where(f"(_before + _n) div {int(every)} > _before div {int(every)}")
    marks = numbered_records(rows, marked, lambda no: no % every == 0, bucket)
    elapsed = F.unix_micros("timestamp") - F.col("_us0")
    return marks.select(
        "partition",
        F.col("record_no").alias("line_count"),
        F.round(F.col("record_no") * F.lit(1_000_000.0) / F.nullif(elapsed, F.lit(0)), 6).alias("rps"),
    )


def first_records(topic_df: DataFrame, n: int = 5, bucket: int = BUCKET) -> DataFrame:
    """The first ``n`` records of each topic partition, numbered from 1 (``record_no``), whatever offsets they have.

    The buckets that hold them follow from counts per bucket; the largest
    offset of these bounds what the scan has to read of the records.
    """
    heads = bucket_counts(topic_df.select("partition", "offset", "timestamp"), bucket).where(F.col("_before") < n)
    last = heads.agg(F.max("_hi"))
    near = topic_df.filter(F.col("offset") <= last.scalar())
    return numbered_records(near, heads.drop("_us0"), lambda no: no <= n, bucket, n)


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """The rows ``show()`` would print: ``n`` rows, in ``order_by`` order when given (a top-k, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def describe_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``position, name, type, nullable`` for each top-level column (metadata only, no job)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def schema_profile(df: DataFrame, column: str = "json", by: str = "partition") -> DataFrame:
    """Merged schema of a ``VARIANT`` column per group: ``by, records, json_schema``.

    For schemaless records this is the data-derived counterpart of a printed
    schema; the aggregate merges partially on each task before the shuffle.
    """
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("records"),
        F.schema_of_variant_agg(column).alias("json_schema"),
    )


def offset_gaps(topic_df: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Holes in each partition's offsets: ``partition, offset, next_offset, missing``.

    ``offset`` is the last present offset before a hole and ``next_offset``
    the first one after it. Offsets are cut into buckets of ``bucket``, and
    counts per bucket (partially aggregated) find those with holes; only their
    rows are ordered, in groups of at most ``bucket``. Bucket edges are
    compared on per-bucket min/max (one row per bucket).
    """
    b = F.expr(f"offset div {int(bucket)}")
    buckets = topic_df.groupBy("partition", b.alias("_b")).agg(
        F.min("offset").alias("_lo"), F.max("offset").alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    return gaps_between(topic_df, buckets, bucket)


def gaps_between(topic_df: DataFrame, buckets: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The holes that ``buckets`` (``partition, _b, _n, _lo, _hi``) show; rows of ``topic_df`` are ordered in damaged buckets only."""
    rows = topic_df.select("partition", "offset").withColumn("_b", F.expr(f"offset div {int(bucket)}"))
    torn = buckets.filter(F.col("_n") != F.col("_hi") - F.col("_lo") + 1).select("partition", "_b", "_hi")
    inner_w = Window.partitionBy("partition", "_b").orderBy("offset")
    inner = rows.join(torn, ["partition", "_b"]).where(F.col("offset") <= F.col("_hi"))
    inner = inner.withColumn("next_offset", F.lead("offset").over(inner_w))
    inner = inner.filter(F.col("next_offset") > F.col("offset") + 1)
    edge_w = Window.partitionBy("partition").orderBy("_b")
    edges = (
        buckets.withColumn("next_offset", F.lead("_lo").over(edge_w))
        .filter(F.col("next_offset") > F.col("_hi") + 1)
        .select("partition", F.col("_hi").alias("offset"), "next_offset")
    )
    gaps = inner.select("partition", "offset", "next_offset").unionByName(edges)
    return gaps.withColumn("missing", F.col("next_offset") - F.col("offset") - 1)
