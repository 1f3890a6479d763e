"""Command line: the three jobs of the source application, on Spark.

    python -m spoolwire upload FILE.csv  --path DIR | --kafka HOST:PORT [--topic data] [--partitions N]
    python -m spoolwire show             --path DIR | --kafka HOST:PORT [--schema patent|NAMES] [--rows 20]
    python -m spoolwire follow           --path DIR | --kafka HOST:PORT --out DIR | --preview N [--checkpoint DIR] [--available-now]

``upload`` publishes every non-empty CSV record as JSON and prints the load
report and the first five records of each partition that it sent; ``show`` reads the topic once, parses it
with a declared schema and prints the schemas and rows; ``follow`` writes
every record with its partition and offset as it arrives to ``--out`` as JSON
lines; ``--preview N`` prints the first N of each micro-batch instead.
The Spark session comes from ``getOrCreate`` (so ``spark-submit`` settings
apply).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from spoolwire.operators.report import first_records, preview
from spoolwire.plans.consume import consume_topic
from spoolwire.plans.upload import upload_csv
from spoolwire.schemas import PATENT_SCHEMA, string_schema
from spoolwire.sources.topic import FileTopic, KafkaTopic, current_end_offsets, read_topic, topic_partitions
from spoolwire.streaming.topic_stream import decode_records, emit_records, stream_topic
from spoolwire.workspace import scratch_path


def _topic(args) -> FileTopic | KafkaTopic:
    if args.kafka:
        return KafkaTopic(args.topic, args.kafka)
    if args.path:
        return FileTopic(args.path, args.topic)
    raise SystemExit("give --path (file topic) or --kafka (broker)")


def _schema(spec: str):
    return PATENT_SCHEMA if spec == "patent" else string_schema([s.strip() for s in spec.split(",") if s.strip()])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spoolwire")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("upload", "show", "follow"):
        c = sub.add_parser(name)
        if name == "upload":
            c.add_argument("csv")
            c.add_argument("--partitions", type=int, default=None)
            c.add_argument("--header-record", action="store_true", help="also send the header line as a record")
        if name == "show":
            c.add_argument("--schema", default="patent", help="'patent' or comma-separated field names")
            c.add_argument("--rows", type=int, default=20)
            c.add_argument("--starting", default="earliest")
        if name == "follow":
            c.add_argument("--out", default=None, help="folder for every record, as JSON lines")
            c.add_argument("--preview", type=int, default=None, help="print so many rows of each micro-batch")
            c.add_argument("--checkpoint", default=None)
            c.add_argument("--available-now", action="store_true", help="drain what is there and stop")
            c.add_argument("--starting", default="earliest")
        c.add_argument("--path", help="folder of a file-backed topic")
        c.add_argument("--kafka", help="bootstrap servers of a Kafka topic")
        c.add_argument("--topic", default="data")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"spoolwire-{args.command}").getOrCreate()
    topic = _topic(args)
    if args.command == "upload":
        before = current_end_offsets(spark, topic) if isinstance(topic, FileTopic) else None
        report = upload_csv(
            spark, args.csv, topic, partitions=args.partitions, include_header_record=args.header_record,
            raise_errors=False,
        )
        report.show(truncate=False)
        if isinstance(topic, FileTopic) and report.first().status == "ok":
            sent = read_topic(spark, topic, starting=before or "earliest")  # this upload's records
            first = first_records(sent, 5).selectExpr("partition", "offset", "record_no", "CAST(value AS STRING) AS value")
            shown = 5 * (topic_partitions(spark, topic) or 1)
            first.orderBy("partition", "offset").show(shown, truncate=False)
        return 0 if report.first().status == "ok" else 1
    if args.command == "show":
        envelope = read_topic(spark, topic, starting=args.starting)
        print("envelope schema:")
        envelope.printSchema()
        parsed = consume_topic(spark, topic, _schema(args.schema), starting=args.starting)
        print("parsed schema:")
        parsed.printSchema()
        preview(parsed, args.rows).show(args.rows, truncate=False)
        return 0
    if not args.out and args.preview is None:
        raise SystemExit("give --out (every record) or --preview (some of each micro-batch)")
    checkpoint = (args.checkpoint or scratch_path(spark, "follow-checkpoint")).rstrip("/")
    stream = decode_records(stream_topic(spark, topic, starting=args.starting, start_store=f"{checkpoint}-start"))
    query = emit_records(
        stream.select("partition", "offset", "key", "value"),
        sink="json" if args.out else "console",
        path=args.out,
        checkpoint_location=checkpoint,
        available_now=args.available_now,
        console_rows=args.preview or 20,
    )
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
