"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query derives its inputs (CSV files, topics) from whole tables with
Spark, writes them to the shared scratch folder, and runs the library's
operators over them. Column names match the oracle SQL exactly.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwire.functions.codec import binary_deserializer, binary_serializer
from spoolwire.functions.envelope import ntz_to_instant, stringify, with_position
from spoolwire.functions.text import head_chars, utf8_ok
from spoolwire.operators.drift import schema_drift
from spoolwire.operators.locate import locate_bad_utf8
from spoolwire.operators.records import deserialize, drop_empty, parse_any, parse_records, split_quarantine
from spoolwire.operators.report import first_records, offset_gaps, preview, progress, schema_profile
from spoolwire.operators.source_order import number_records, source_head
from spoolwire.plans.consume import consume_topic
from spoolwire.plans.upload import upload_csv
from spoolwire.schemas import string_schema
from spoolwire.sinks.topic import publish
from spoolwire.sources.csv import audit_encoding, csv_headers, scan_csv
from spoolwire.sources.topic import FileTopic, missing_ranges, read_topic
from spoolwire.streaming.live import (
    batch_writer,
    drop_resent,
    live_progress,
    read_batches,
    read_progress,
    seen_gaps,
    watch_offsets,
)
from spoolwire.streaming.topic_stream import decode_records, emit_records, run_stream, stream_topic
from spoolwire.workspace import scratch_path

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
EVENT_PARTITIONS = 3

_cache: dict = {}
_lock = threading.RLock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _memo(spark: SparkSession, key: tuple, build: Callable[[], str]) -> str:
    """Build a derived input once per session (inputs are immutable once written)."""
    k = (id(spark.sparkContext), spark.sparkContext.applicationId) + key
    with _lock:
        if k not in _cache:
            _cache[k] = build()
        return _cache[k]


def forget(*labels: str) -> None:
    """Build the inputs of these labels again on their next use."""
    with _lock:
        for k in [k for k in _cache if k[2] in labels]:
            del _cache[k]


# ---------------------------------------------------------------- fixtures


def write_csv(df: DataFrame, path: str) -> str:
    """All-string rows as RFC 4180 CSV (one header per part file)."""
    (
        stringify(df)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)  # the writer trims by default
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_lines(lines: DataFrame, header: str, path: str) -> str:
    """Raw text lines (one string column) under a header line in every part file, written verbatim."""
    (
        lines.toDF(header)
        .write.option("header", True)
        .option("sep", "\u0001")  # never in the data: no field splitting or quoting on write
        .option("quote", "\u0000")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    return _memo(
        spark,
        ("customer_csv", sf_dir),
        lambda: write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "customer-csv")),
    )


def orders_csv(spark: SparkSession, sf_dir: str) -> str:
    return _memo(
        spark,
        ("orders_csv", sf_dir),
        lambda: write_csv(table(spark, sf_dir, "orders"), scratch_path(spark, "orders-csv")),
    )


def lineitem_csv(spark: SparkSession, sf_dir: str) -> str:
    return _memo(
        spark,
        ("lineitem_csv", sf_dir),
        lambda: write_csv(table(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem-csv")),
    )


def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    return _memo(
        spark,
        ("documents_csv", sf_dir),
        lambda: write_csv(table(spark, sf_dir, "documents"), scratch_path(spark, "documents-csv")),
    )


def ragged_customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows as CSV lines whose shape depends on the market segment:
    AUTOMOBILE long (two extra fields), BUILDING short (three fields),
    FURNITURE an empty name, HOUSEHOLD all fields empty (with even keys two
    more than the header has), MACHINERY a quoted name holding a comma and
    doubled quotes, the rest plain."""
    c = stringify(table(spark, sf_dir, "customer"))
    k, n, nk, a, m = (F.col(x) for x in CUSTOMER_COLUMNS)
    quoted = F.concat(F.lit('"'), F.replace(F.concat(n, F.lit(', "'), m, F.lit('"')), F.lit('"'), F.lit('""')), F.lit('"'))
    line = (
        F.when(m == "AUTOMOBILE", F.concat_ws(",", k, n, nk, a, m, n, F.lit("")))
        .when(m == "BUILDING", F.concat_ws(",", k, n, nk))
        .when(m == "FURNITURE", F.concat_ws(",", k, F.lit(""), nk, a, m))
        .when((m == "HOUSEHOLD") & (k.cast("long") % 2 == 0), F.lit(",,,,,,"))
        .when(m == "HOUSEHOLD", F.lit(",,,,"))
        .when(m == "MACHINERY", F.concat_ws(",", k, quoted, nk, a, m))
        .otherwise(F.concat_ws(",", k, n, nk, a, m))
    )
    return c.select(line.alias("line"))


def messy_csv(spark: SparkSession, sf_dir: str) -> str:
    """Customer rows (key, name, segment) as CSV that only whole-file parsing
    reads right, by key modulo 7: plain; a stray quote; a stray quote beside a
    quoted line break, with an even number of quotes per line; a lone carriage
    return inside quotes; a line of white space before the row; blank lines
    before the row; doubled quotes. One file per thousand keys."""

    def build() -> str:
        k, n, m = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
        plain, kind = F.concat_ws(",", k, n, m), F.col("c_custkey") % 7
        line = (
            F.when(kind == 1, F.concat(k, F.lit('" x,'), n, F.lit(","), m))
            .when(kind == 2, F.concat(k, F.lit('" x,"first '), n, F.lit('\nsecond",7"')))
            .when(kind == 3, F.concat(k, F.lit(',"x\ry",'), m))
            .when(kind == 4, F.concat(F.lit("   \n"), plain))
            .when(kind == 5, F.concat(F.lit("\n\n"), plain))
            .when(kind == 6, F.concat(k, F.lit(',"say ""hi"", '), n, F.lit('",'), m))
            .otherwise(plain)
        )
        files = table(spark, sf_dir, "customer").select(F.expr("c_custkey div 1000").alias("g"), line.alias("line"))
        text = F.concat(F.lit("id,a,b\n"), F.array_join(F.sort_array(F.collect_list("line")), "\n"))
        path = scratch_path(spark, "messy-csv")
        files.groupBy("g").agg(text.alias("value")).write.partitionBy("g").text(path)
        return f"{path}/g=*"

    return _memo(spark, ("messy_csv", sf_dir), build)


def blank_lines_csv(spark: SparkSession, sf_dir: str) -> str:
    """Customer rows (key, name, segment) as plain lines; before some of them, by
    key modulo 6, a line of a tab, a form feed, a control character, blanks,
    or nothing at all. One file per thousand keys."""

    def build() -> str:
        k, n, m = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
        before = F.get(F.array(*map(F.lit, ["", "\t\n", "\f\n", "\x01\n", " \t \n", "\n"])), F.col("c_custkey") % 6)
        files = table(spark, sf_dir, "customer").select(F.expr("c_custkey div 1000").alias("g"), F.concat(before, F.concat_ws(",", k, n, m)).alias("line"))
        text = F.concat(F.lit("id,a,b\n"), F.array_join(F.sort_array(F.collect_list("line")), "\n"))
        path = scratch_path(spark, "blank-lines-csv")
        files.groupBy("g").agg(text.alias("value")).write.partitionBy("g").text(path)
        return f"{path}/g=*"

    return _memo(spark, ("blank_lines_csv", sf_dir), build)


def _in_files(rows: DataFrame, key: str, per_file: int) -> DataFrame:
    """Rows in the order of ``key``, ``per_file`` keys to a file, whose folders ``g=...`` sort by it."""
    g = F.lpad(F.expr(f"cast({key} div {per_file} as string)"), 12, "0")
    return rows.withColumn("g", g).repartition("g").sortWithinPartitions("g", key)


def orders_csv_in_order(spark: SparkSession, sf_dir: str) -> str:
    """Orders by key as CSV files of 8192 keys each."""

    def build() -> str:
        path = scratch_path(spark, "orders-in-order")
        rows = _in_files(table(spark, sf_dir, "orders").select(ORDER_COLUMNS), "o_orderkey", 8192)
        stringify(rows).write.partitionBy("g").options(header=True, escape='"').csv(path)
        return f"{path}/g=*"

    return _memo(spark, ("orders_in_order", sf_dir), build)


def events_text_in_order(spark: SparkSession, sf_dir: str) -> str:
    """JSON lines of ``events`` by id, 5000 ids to a file; ``error`` lines end in the byte 0xFF."""

    def build() -> str:
        rec = _event_records(spark, sf_dir)
        json = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"}).cast("binary")
        line = F.when(F.col("event_type") == "error", F.concat(json, F.unhex(F.lit("FF")))).otherwise(json)
        path = scratch_path(spark, "events-text-in-order")
        rows = _in_files(rec.select(line.cast("string").alias("value"), "_eid"), "_eid", 5000)
        rows.select("value", "g").write.partitionBy("g").text(path)
        return f"{path}/g=*"

    return _memo(spark, ("events_text_in_order", sf_dir), build)


def documents_csv_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents as many CSV files of at most 200 records, so that multi-line reading is spread over tasks."""

    def build() -> str:
        path = scratch_path(spark, "documents-csv-files")
        writer = stringify(table(spark, sf_dir, "documents")).write.option("maxRecordsPerFile", 200)
        writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        return path

    return _memo(spark, ("documents_csv_files", sf_dir), build)


def ragged_csv(spark: SparkSession, sf_dir: str) -> str:
    return _memo(
        spark,
        ("ragged_csv", sf_dir),
        lambda: write_lines(
            ragged_customer_lines(spark, sf_dir), ",".join(CUSTOMER_COLUMNS), scratch_path(spark, "ragged-csv")
        ),
    )


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        *[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS],
        F.col("event_id").alias("_eid"),
        ntz_to_instant("ts").alias("_ts"),
    )


def events_topic(spark: SparkSession, sf_dir: str) -> FileTopic:
    """The events table published as JSON records: partition ``event_id mod 3``,
    offsets in ``event_id`` order, record timestamp = event time."""

    def build() -> str:
        topic = FileTopic(scratch_path(spark, "events-topic"), "data")
        rec = _event_records(spark, sf_dir)
        publish(
            rec,
            topic,
            columns=EVENT_COLUMNS,
            partitions=EVENT_PARTITIONS,
            partition_by=F.pmod(F.col("_eid"), F.lit(EVENT_PARTITIONS)),
            order_by=["_eid"],
            timestamp_column="_ts",
        )
        return topic.path

    return FileTopic(_memo(spark, ("events_topic", sf_dir), build), "data")


def events_topic_mixed(spark: SparkSession, sf_dir: str) -> FileTopic:
    """Events topic of producers that differ: every fifth id has ``uid`` for
    ``user_id``, every seventh its ``event_id`` as a number, every eleventh lost
    its closing brace."""

    def value(j):
        eid = F.col("_eid")
        j = F.when(eid % 5 == 0, F.replace(j, F.lit('"user_id":'), F.lit('"uid":'))).otherwise(j)
        j = F.when(eid % 7 == 0, F.regexp_replace(j, '"event_id":"([0-9]+)"', '"event_id":$1')).otherwise(j)
        return F.when(eid % 11 == 0, F.substring(j, F.lit(1), F.length(j) - 1)).otherwise(j).cast("binary")

    return _wire_events_topic(spark, sf_dir, "events-mixed", value)


def _wire_events_topic(spark: SparkSession, sf_dir: str, label: str, value) -> FileTopic:
    def build() -> str:
        topic = FileTopic(scratch_path(spark, label), "data")
        rec = _event_records(spark, sf_dir)
        json = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})
        wire = rec.select(
            F.lit(None).cast("binary").alias("key"), value(json).alias("value"), "_eid", "_ts"
        )
        publish(
            wire,
            topic,
            wire=True,
            partitions=EVENT_PARTITIONS,
            partition_by=F.pmod(F.col("_eid"), F.lit(EVENT_PARTITIONS)),
            order_by=["_eid"],
            timestamp_column="_ts",
        )
        return topic.path

    return FileTopic(_memo(spark, (label, sf_dir), build), "data")


def events_topic_damaged(spark: SparkSession, sf_dir: str) -> FileTopic:
    """Events topic whose ``error`` records lost their closing brace (malformed JSON)."""
    is_error = F.col("event_type") == "error"
    return _wire_events_topic(
        spark,
        sf_dir,
        "events-damaged",
        lambda j: F.when(is_error, F.substring(j, F.lit(1), F.length(j) - 1)).otherwise(j).cast("binary"),
    )


def events_topic_bad_bytes(spark: SparkSession, sf_dir: str) -> FileTopic:
    """Events topic whose ``error`` records end in the byte 0xFF (invalid UTF-8)."""
    is_error = F.col("event_type") == "error"
    return _wire_events_topic(
        spark,
        sf_dir,
        "events-bad-bytes",
        lambda j: F.when(is_error, F.concat(j.cast("binary"), F.unhex(F.lit("FF")))).otherwise(j.cast("binary")),
    )


def events_topic_lossy(spark: SparkSession, sf_dir: str) -> FileTopic:
    """A copy of the events topic without its ``error`` records, as left by lost data."""

    def build() -> str:
        src = read_topic(spark, events_topic(spark, sf_dir))
        event_type = F.get_json_object(F.col("value").cast("string"), "$.event_type")
        path = scratch_path(spark, "events-lossy")
        src.filter(event_type != "error").write.partitionBy("partition").parquet(path)
        return path

    return FileTopic(_memo(spark, ("events_lossy", sf_dir), build), "data")


def events_topic_losses(spark: SparkSession, sf_dir: str) -> FileTopic:
    """A copy of the events topic and its recorded ends that lost the records of
    partition 0 from offset 500 on, the ``error`` records of partition 1 and all
    of partition 2."""

    def build() -> str:
        source = events_topic(spark, sf_dir)
        event_type = F.get_json_object(F.col("value").cast("string"), "$.event_type")
        p = F.col("partition")
        left = ((p == 0) & (F.col("offset") < 500)) | ((p == 1) & (event_type != "error"))
        copy = FileTopic(scratch_path(spark, "events-losses"), "data")
        read_topic(spark, source).filter(left).write.partitionBy("partition").parquet(copy.path)
        spark.read.parquet(source.ends_path).write.parquet(copy.ends_path)
        return copy.path

    return FileTopic(_memo(spark, ("events_losses", sf_dir), build), "data")


# ---------------------------------------------------------------- queries


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-derived all-string scan of a CSV written from ``customer``."""
    df = scan_csv(spark, customer_csv(spark, sf_dir))
    return df.select(csv_headers(df))


def q_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 multi-line: whole multilingual texts with quotes, commas and newlines."""
    df = scan_csv(spark, documents_csv(spark, sf_dir), multiline=True)
    return df.select(csv_headers(df))


def _overflow_as_json(df: DataFrame) -> DataFrame:
    # presentation only: the overflow array as JSON text, so results compare as plain strings
    return df.withColumn("_overflow", F.to_json("_overflow"))


def q_csv_documents_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 multi-line in parallel: the same texts in many files, one task each."""
    df = scan_csv(spark, documents_csv_files(spark, sf_dir))
    return df.select(csv_headers(df))


def q_csv_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stray quotes, line breaks in quotes, a lone CR, white-space lines (kept) and blank lines (skipped)."""
    df = scan_csv(spark, messy_csv(spark, sf_dir))
    return df.select(csv_headers(df))


def q_csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty vs missing fields, overflow capture, quoted fields."""
    return _overflow_as_json(scan_csv(spark, ragged_csv(spark, sf_dir)))


def q_header_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: parity mode, the header line re-emitted as the first record."""
    df = scan_csv(spark, customer_csv(spark, sf_dir), include_header_record=True)
    return df.select(csv_headers(df))


def q_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with every field null or empty are dropped, overlong rows kept."""
    return _overflow_as_json(drop_empty(scan_csv(spark, ragged_csv(spark, sf_dir))))


def q_upload_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default upload keeps lines of white space and control characters, and drops blank ones."""
    topic = FileTopic(scratch_path(spark, "blank-lines-topic"), "data")
    upload_csv(spark, blank_lines_csv(spark, sf_dir), topic, partitions=EVENT_PARTITIONS)
    return consume_topic(spark, topic, string_schema(["id", "a", "b"]))


def q_upload_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default upload keeps the order of the source: each partition an even range of it, at dense offsets."""
    topic = FileTopic(scratch_path(spark, "ordered-topic"), "data")
    upload_csv(spark, orders_csv_in_order(spark, sf_dir), topic, partitions=EVENT_PARTITIONS)
    return read_topic(spark, topic).select("partition", "offset", F.col("value").cast("string").alias("value"))


def q_source_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its number in the source and in its file, over many files and splits."""
    rows = scan_csv(spark, orders_csv_in_order(spark, sf_dir), multiline=False, with_position=True)
    return number_records(rows).select("record_no", "file_record_no", *ORDER_COLUMNS)


def q_source_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records of the source, in its order, numbered."""
    rows = scan_csv(spark, orders_csv_in_order(spark, sf_dir), multiline=False, with_position=True)
    return source_head(rows, 5).select("record_no", *ORDER_COLUMNS)


def q_missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load reports of a source that is there and of one that isn't."""
    topic = FileTopic(scratch_path(spark, "missing-topic"), "data")
    found = upload_csv(spark, customer_csv(spark, sf_dir), topic, raise_errors=False)
    absent = upload_csv(spark, scratch_path(spark, "absent"), topic, raise_errors=False)
    return found.unionByName(absent).select("rows_in", "rows_sent", "status", F.split("error", ":")[0].alias("error"))


def q_utf8_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File, line and byte of every invalid sequence of a text source in many files."""
    found = locate_bad_utf8(spark, events_text_in_order(spark, sf_dir))
    return found.select(F.regexp_extract("file", "g=(\\d+)", 1).cast("long").alias("file_no"), "line", "byte", "text")


def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O19, O20 (+O24 audit, O12 publish): the upload job's load report for the ragged CSV."""
    topic = FileTopic(scratch_path(spark, "upload-topic"), "data")
    report = upload_csv(spark, ragged_csv(spark, sf_dir), topic, partitions=EVENT_PARTITIONS)
    return report.select("topic", "rows_in", "rows_sent", "rows_skipped", "rows_long", "status")


def q_upload_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON sent for ragged rows, surplus fields included, rows both overlong and all empty too."""
    topic = FileTopic(scratch_path(spark, "ragged-topic"), "data")
    upload_csv(spark, ragged_csv(spark, sf_dir), topic, partitions=EVENT_PARTITIONS)
    return read_topic(spark, topic).select(F.col("value").cast("string").alias("value"))


def q_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: ``orders`` CSV -> upload (audit, scan, drop empty, JSON, publish) ->
    bounded read -> declared-schema parse -> ``key`` + columns."""
    topic = FileTopic(scratch_path(spark, "orders-topic"), "data")
    upload_csv(spark, orders_csv(spark, sf_dir), topic, partitions=4)
    return consume_topic(spark, topic, string_schema(ORDER_COLUMNS))


def q_ingest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship path on the largest table: ``lineitem`` CSV -> upload -> typed records."""
    topic = FileTopic(scratch_path(spark, "lineitem-topic"), "data")
    upload_csv(spark, lineitem_csv(spark, sf_dir), topic, partitions=8)
    return consume_topic(spark, topic, string_schema(LINEITEM_COLUMNS))


def q_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published as JSON bytes at dense per-partition offsets."""
    env = read_topic(spark, events_topic(spark, sf_dir))
    return env.select("partition", "offset", F.col("value").cast("string").alias("value"))


def q_topic_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded read between per-partition starting and ending offsets."""
    env = read_topic(
        spark,
        events_topic(spark, sf_dir),
        starting='{"data": {"0": 100, "1": 200}}',
        ending='{"data": {"2": 3000}}',
    )
    return env.select("partition", "offset", F.col("value").cast("string").alias("value"))


def q_parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast, ``from_json`` by a declared schema, flatten with ``key``."""
    return consume_topic(spark, events_topic(spark, sf_dir), string_schema(EVENT_COLUMNS))


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O28 + corrupt-record column: malformed records keep their raw text, fields null."""
    env = read_topic(spark, events_topic_damaged(spark, sf_dir))
    return parse_records(
        env, string_schema(EVENT_COLUMNS), keep=("partition", "offset"), corrupt_column="_corrupt_record"
    )


def q_quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean half of the quarantine split."""
    env = read_topic(spark, events_topic_damaged(spark, sf_dir))
    parsed = parse_records(
        env, string_schema(EVENT_COLUMNS), keep=("partition", "offset"), corrupt_column="_corrupt_record"
    )
    good, _ = split_quarantine(parsed)
    return good


def q_parse_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemaless JSON to VARIANT, fields extracted by path, schema per record."""
    env = parse_any(read_topic(spark, events_topic(spark, sf_dir)))
    props = F.try_parse_json(F.variant_get("json", "$.props", "string"))
    return env.select(
        "partition",
        "offset",
        F.variant_get("json", "$.event_id", "string").alias("event_id"),
        F.variant_get(props, "$.k", "bigint").alias("k"),
        F.schema_of_variant("json").alias("json_schema"),
    )


def q_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position and strictly decoded payload of every record."""
    return with_position(read_topic(spark, events_topic(spark, sf_dir)), strict=True)


def q_utf8_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O24 per record: which payloads are valid UTF-8."""
    env = read_topic(spark, events_topic_bad_bytes(spark, sf_dir))
    return env.select("partition", "offset", utf8_ok("value").alias("ok"))


def q_utf8_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O24 whole-source audit: JSON lines of ``events`` written as a text source,
    ``error`` lines ending in byte 0xFF; totals over all files."""

    def build() -> str:
        rec = _event_records(spark, sf_dir)
        json = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"}).cast("binary")
        line = F.when(F.col("event_type") == "error", F.concat(json, F.unhex(F.lit("FF")))).otherwise(json)
        path = scratch_path(spark, "events-text")
        rec.select(line.cast("string").alias("value")).write.text(path)
        return path

    path = _memo(spark, ("events_text", sf_dir), build)
    return audit_encoding(spark, path).agg(
        F.sum("lines").alias("lines"), F.sum("bad_lines").alias("bad_lines")
    )


def q_text_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text is checked and measured; its first 100 characters shown."""
    docs = scan_csv(spark, documents_csv(spark, sf_dir))
    return docs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("chars"),
        F.octet_length("text").cast("long").alias("bytes"),
        utf8_ok("text").alias("utf8_ok"),
        head_chars("text", 100).alias("head"),
    )


def q_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 1000 records per partition, running count and records per second."""
    return progress(read_topic(spark, events_topic(spark, sf_dir)), every=1000)


def q_progress_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress over a topic whose offsets have holes counts records, not offsets."""
    return progress(read_topic(spark, events_topic_lossy(spark, sf_dir)), every=1000, bucket=1 << 10)


def q_first_records_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records of each partition, whatever offsets are left."""
    env = first_records(read_topic(spark, events_topic_lossy(spark, sf_dir)), n=5)
    return env.select("partition", "offset", "record_no", F.col("value").cast("string").alias("value"))


def q_first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records of each partition, numbered."""
    env = first_records(read_topic(spark, events_topic(spark, sf_dir)), n=5)
    return env.select("partition", "offset", "record_no", F.col("value").cast("string").alias("value"))


def q_console_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows a console preview shows, in log order."""
    env = read_topic(spark, events_topic(spark, sf_dir))
    parsed = parse_records(env, string_schema(EVENT_COLUMNS), keep=("partition", "offset", "key"))
    return preview(parsed, 20, order_by=["partition", "offset"])


def q_schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O22 for schemaless records: merged JSON schema and record count per partition."""
    return schema_profile(parse_any(read_topic(spark, events_topic(spark, sf_dir))))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that records of a mixed topic have beside, instead of, or without those of the declared schema."""
    return schema_drift(read_topic(spark, events_topic_mixed(spark, sf_dir)), string_schema(EVENT_COLUMNS))


def q_offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset holes in a topic that lost its ``error`` records."""
    return offset_gaps(read_topic(spark, events_topic_lossy(spark, sf_dir)))


def q_missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every range of offsets that a damaged topic lost: a tail, holes, a whole partition."""
    return missing_ranges(spark, events_topic_losses(spark, sf_dir))


def q_keyed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O12 keyed: ``customer`` records keyed by market segment, key and payload as they come back."""
    topic = FileTopic(scratch_path(spark, "customer-keyed"), "data")
    publish(stringify(table(spark, sf_dir, "customer")), topic, key_column="c_mktsegment", partitions=4)
    return read_topic(spark, topic).select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def q_csv_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pluggable serializer (CSV text) and the matching deserializer."""
    topic = FileTopic(scratch_path(spark, "events-csv-wire"), "data")
    rec = _event_records(spark, sf_dir)
    publish(
        rec,
        topic,
        columns=EVENT_COLUMNS,
        serializer=F.to_csv,
        partitions=EVENT_PARTITIONS,
        partition_by=F.pmod(F.col("_eid"), F.lit(EVENT_PARTITIONS)),
        order_by=["_eid"],
    )
    ddl = ", ".join(f"{c} string" for c in EVENT_COLUMNS)
    env = deserialize(read_topic(spark, topic), lambda v: F.from_csv(v.cast("string"), ddl))
    return env.select("partition", "offset", "record.*")


def q_binary_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through a topic in a binary format that Spark has no built-in for; ``lang`` may be null."""
    docs = table(spark, sf_dir, "documents")
    rec = stringify(docs.select(*DOCUMENT_COLUMNS)).withColumn("lang", F.nullif("lang", F.lit("en")))
    topic = FileTopic(scratch_path(spark, "documents-binary"), "data")
    publish(
        rec.withColumn("_id", F.col("doc_id").cast("long")),
        topic,
        columns=DOCUMENT_COLUMNS,
        serializer=binary_serializer,
        partitions=EVENT_PARTITIONS,
        partition_by=F.pmod(F.col("_id"), F.lit(EVENT_PARTITIONS)),
        order_by=["_id"],
    )
    env = deserialize(read_topic(spark, topic), binary_deserializer(DOCUMENT_COLUMNS, failfast=True))
    return env.select("partition", "offset", F.md5("value").alias("value_md5"), "record.*")


def q_topic_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O10 strict: a bounded read that first proves the range has no missing offsets."""
    env = read_topic(spark, events_topic(spark, sf_dir), fail_on_data_loss=True)
    return env.select("partition", "offset", F.col("value").cast("string").alias("value"))


def q_stream_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O8 + O9: a stream started from per-partition offsets, drained with availableNow."""
    sink = scratch_path(spark, "stream-offsets-sink")
    run_stream(
        spark,
        events_topic(spark, sf_dir),
        sink,
        scratch_path(spark, "stream-offsets-checkpoint"),
        starting='{"data": {"0": 100, "2": 2500}}',
    )
    return spark.read.parquet(sink).select("partition", "offset", "value")


def q_stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous decode-and-emit job, drained with availableNow."""
    sink = scratch_path(spark, "stream-sink")
    run_stream(spark, events_topic(spark, sf_dir), sink, scratch_path(spark, "stream-checkpoint"))
    out = spark.read.parquet(sink)
    return out.select(
        "partition",
        "offset",
        "key",
        "value",
        F.variant_get("json", "$.event_type", "string").alias("event_type"),
    )


def q_variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields of records that the stream stored as VARIANT; the scan reads their shredded columns only."""
    sink = scratch_path(spark, "variant-sink")
    run_stream(spark, events_topic(spark, sf_dir), sink, scratch_path(spark, "variant-checkpoint"))
    field = lambda c: F.variant_get("json", f"$.{c}", "string").alias(c)
    return spark.read.parquet(sink).select("partition", "offset", field("event_type"), field("user_id"))


def q_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream started at ``latest`` over half of the events, drained,
    and drained again with its checkpoint after the other half came: exactly
    the second half arrives."""
    topic = FileTopic(scratch_path(spark, "resume-topic"), "data")
    sink, checkpoint = scratch_path(spark, "resume-sink"), scratch_path(spark, "resume-checkpoint")
    for half in (0, 1):
        publish(
            _event_records(spark, sf_dir).filter(F.col("_eid") % 2 == half),
            topic,
            columns=EVENT_COLUMNS,
            partitions=EVENT_PARTITIONS,
            partition_by=F.pmod(F.col("_eid"), F.lit(EVENT_PARTITIONS)),
            order_by=["_eid"],
        )
        run_stream(spark, topic, sink, checkpoint, starting="latest")
    return spark.read.parquet(sink).select("partition", "offset", "value")


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O30 + S14: the continuous job over a damaged topic, malformed records routed to a folder of their own."""
    sink = scratch_path(spark, "stream-quarantine-sink")
    run_stream(
        spark,
        events_topic_damaged(spark, sf_dir),
        sink,
        scratch_path(spark, "stream-quarantine-checkpoint"),
        corrupt_column="_corrupt_record",
        max_files_per_trigger=8,
    )
    out = spark.read.parquet(sink)
    return out.select(
        "partition",
        "offset",
        F.col("quarantined").cast("boolean").alias("quarantined"),
        F.variant_get("json", "$.event_type", "string").alias("event_type"),
        "_corrupt_record",
    )


def _publish_thirds(spark: SparkSession, sf_dir: str, topic: FileTopic, each: Callable[[], object], keep=None) -> None:
    """Events as they come in: a third of the ids after the other, ``each`` called after every one of them."""
    rec = _event_records(spark, sf_dir)
    third = table(spark, sf_dir, "events").agg((F.max("event_id") + 3) / 3)
    part = F.floor(F.col("_eid") / third.scalar())
    for i in range(3):
        wire = rec.where(part == i).select(
            F.lit(None).cast("binary").alias("key"), "_eid", "_ts", "event_type",
            F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        )
        publish(
            wire, topic, wire=True, partitions=EVENT_PARTITIONS, order_by=["_eid"], timestamp_column="_ts", keep=keep,
            partition_by=F.pmod(F.col("_eid"), F.lit(EVENT_PARTITIONS)),
        )
        each()


def q_stream_live_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows written while events come in by thirds, the stream started anew for each."""
    topic = FileTopic(scratch_path(spark, "live-topic"), "data")
    out, checkpoint = scratch_path(spark, "live-progress"), scratch_path(spark, "live-checkpoint")
    _publish_thirds(spark, sf_dir, topic, lambda: live_progress(spark, topic, out, checkpoint))
    return read_progress(spark, out).select("partition", "line_count", "rps")


def q_stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holes from the state of a stream over a topic that lost records, drained file by file over two runs."""
    topic = events_topic_lossy(spark, sf_dir)
    out, checkpoint = scratch_path(spark, "offsets-seen"), scratch_path(spark, "offsets-checkpoint")
    for _ in range(2):
        watch_offsets(spark, topic, out, checkpoint, max_files_per_trigger=3, bucket=1 << 10)
    return seen_gaps(spark, out, read_topic(spark, topic), bucket=1 << 10)


def q_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded records written by batch number; the first run fails after a batch's write, the second repeats that batch."""
    out, checkpoint = scratch_path(spark, "once-sink"), scratch_path(spark, "once-checkpoint")
    topic, write = events_topic(spark, sf_dir), batch_writer(out)
    stream = lambda: decode_records(stream_topic(spark, topic, max_files_per_trigger=2))

    def broken(batch: DataFrame, number: int) -> None:
        write(batch, number)
        raise RuntimeError("lost after the write, before the commit")

    for each in (broken, write):
        query = emit_records(stream(), checkpoint_location=checkpoint, foreach_batch=each)
        try:
            query.awaitTermination()
        except Exception as e:
            if each is write or "before the commit" not in str(e):
                raise
    return read_batches(spark, out).select("partition", "offset", "value")


def q_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O12 (at least once), O30: a topic to which every second event was sent twice, drained to distinct records."""
    topic = FileTopic(scratch_path(spark, "resent-topic"), "data")
    rec = _event_records(spark, sf_dir)
    for again in (rec, rec.where("_eid % 2 = 0")):
        publish(again, topic, columns=EVENT_COLUMNS, partitions=EVENT_PARTITIONS, timestamp_column="_ts")
    sink, checkpoint = scratch_path(spark, "distinct-sink"), scratch_path(spark, "distinct-checkpoint")
    # events of the whole table count as on time
    distinct = drop_resent(stream_topic(spark, topic), "100000 days")
    emit_records(decode_records(distinct), "parquet", sink, checkpoint).awaitTermination()
    return spark.read.parquet(sink).select("value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_roundtrip": q_ingest_roundtrip,
    "ingest_lineitem": q_ingest_lineitem,
    "csv_scan": q_csv_scan,
    "csv_documents": q_csv_documents,
    "csv_documents_split": q_csv_documents_split,
    "csv_messy": q_csv_messy,
    "csv_ragged": q_csv_ragged,
    "header_record": q_header_record,
    "drop_empty": q_drop_empty,
    "load_report": q_load_report,
    "upload_ragged": q_upload_ragged,
    "upload_messy": q_upload_messy,
    "upload_in_order": q_upload_in_order,
    "source_numbers": q_source_numbers,
    "source_head": q_source_head,
    "missing_source": q_missing_source,
    "utf8_locate": q_utf8_locate,
    "envelope": q_envelope,
    "topic_range": q_topic_range,
    "parse_records": q_parse_records,
    "quarantine": q_quarantine,
    "quarantine_good": q_quarantine_good,
    "parse_any": q_parse_any,
    "positions": q_positions,
    "utf8_check": q_utf8_check,
    "utf8_audit": q_utf8_audit,
    "text_prefix": q_text_prefix,
    "progress": q_progress,
    "first_records": q_first_records,
    "progress_holes": q_progress_holes,
    "first_records_holes": q_first_records_holes,
    "console_preview": q_console_preview,
    "schema_profile": q_schema_profile,
    "schema_drift": q_schema_drift,
    "offset_gaps": q_offset_gaps,
    "missing_ranges": q_missing_ranges,
    "keyed_publish": q_keyed_publish,
    "csv_wire": q_csv_wire,
    "binary_wire": q_binary_wire,
    "stream_drain": q_stream_drain,
    "topic_checked": q_topic_checked,
    "stream_from_offsets": q_stream_from_offsets,
    "stream_resume": q_stream_resume,
    "variant_fields": q_variant_fields,
    "stream_quarantine": q_stream_quarantine,
    "stream_live_progress": q_stream_live_progress,
    "stream_gaps": q_stream_gaps,
    "stream_once": q_stream_once,
    "stream_distinct": q_stream_distinct,
}
