"""CSV file(s) -> topic: audit, scan, drop empty records, serialise, publish, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spoolwire.errors import EncodingError, SourceNotFound
from spoolwire.operators.records import non_empty
from spoolwire.sinks.topic import publish
from spoolwire.sources.csv import OVERFLOW, audit_splits, csv_header, csv_headers, scan_csv, source_exists
from spoolwire.sources.topic import KafkaTopic, Topic
from spoolwire.workspace import delete_path, scratch_path

REPORT_SCHEMA = (
    "source string, topic string, rows_in long, rows_sent long, rows_skipped long, rows_long long, "
    "status string, error string"
)
#: JSON key of the fields beyond the header, as a reader that files them under a null name would write it.
OVERFLOW_KEY = "null"


def upload_csv(
    spark: SparkSession,
    path: str,
    topic: Topic,
    *,
    partitions: int | None = None,
    multiline: bool | None = None,
    encoding: str = "utf-8",
    include_header_record: bool = False,
    audit: bool = True,
    raise_errors: bool = True,
    **publish_options,
) -> DataFrame:
    """Publish every non-empty record of a CSV source as one JSON message each.

    Returns the load report (one row). The UTF-8 audit covers the whole
    source before anything is sent, so a bad byte late in a file cannot leave
    a partial upload. The same pass shows whether the source can be read line
    by line with equal rows (:func:`line_safe`); only then are its files split
    across tasks, unless ``multiline`` says otherwise. It also counts the records
    of each split, so that a source read line by line is parsed only once. Fields beyond the header
    travel under the key ``"null"``, which only long rows have. Records are
    written in source order by the tasks that read them, unless publish options
    place them. Counts come from an observation inside the publish itself.
    With ``raise_errors=False`` any failure is reported in the row
    (``status='failed'``) instead of raised.
    """
    name = getattr(topic, "name", str(topic))
    sums_path = splits = None
    try:
        if audit and encoding.lower().replace("_", "-") in ("utf-8", "utf8"):
            if not source_exists(spark, path):
                raise SourceNotFound(path)
            found = audit_splits(spark, path, len(csv_header(spark, path, multiline=False)))
            sums_path = scratch_path(spark, "splits")
            found.write.parquet(sums_path)  # one small row per split
            splits = spark.read.schema(found.schema).parquet(sums_path)
            total = splits.agg(F.sum("bad_lines").alias("bad"), F.sum("unsafe_lines").alias("unsafe")).first()
            if total.bad:
                raise EncodingError(f"invalid UTF-8 on {total.bad} lines of {path}; re-encode the source as UTF-8")
            if multiline is None:
                multiline = bool(total.unsafe)
            if multiline or total.unsafe or include_header_record:
                splits = None  # not the splits and records that the scan has
        placed = any(publish_options.get(k) is not None for k in ("key_column", "partition_by", "order_by")) or isinstance(topic, KafkaTopic)
        records = scan_csv(
            spark, path, multiline=multiline is not False, encoding=encoding, include_header_record=include_header_record,
            with_position=not placed,
        )
        fields = csv_headers(records)
        optional = [OVERFLOW_KEY] if OVERFLOW_KEY not in fields else [OVERFLOW]
        records = records.withColumnRenamed(OVERFLOW, optional[0])
        keep = non_empty(records, fields) | F.col(f"`{optional[0]}`").isNotNull()
        obs = Observation("load")
        publish(
            records, topic, columns=fields, optional_columns=optional, partitions=partitions, keep=keep, observation=obs,
            in_source_order=not placed, splits=None if placed else splits, **publish_options,
        )
        m = obs.get
        row = (path, name, m["rows_in"], m["rows_sent"], m["rows_skipped"], m["rows_long"], "ok", None)
    except Exception as e:
        if raise_errors:
            raise
        row = (path, name, None, None, None, None, "failed", f"{type(e).__name__}: {e}")
    finally:
        if sums_path:
            delete_path(spark, sums_path)
    return spark.createDataFrame([row], REPORT_SCHEMA)
