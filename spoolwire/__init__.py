"""spoolwire: tabular files to a record log and back, as Spark DataFrame operators."""

from spoolwire.errors import DataLossError, EncodingError, HeaderMismatch, SourceNotFound
from spoolwire.functions import (
    ENVELOPE,
    decode_envelope,
    decode_strict,
    head_chars,
    stringify,
    to_wire,
    utf8_ok,
    with_position,
)
from spoolwire.operators import (
    describe_schema,
    drop_empty,
    first_records,
    load_report,
    locate_bad_utf8,
    number_records,
    offset_gaps,
    parse_any,
    parse_records,
    preview,
    progress,
    schema_drift,
    schema_profile,
    source_head,
)
from spoolwire.plans import consume_topic, upload_csv
from spoolwire.schemas import PATENT_SCHEMA, string_schema
from spoolwire.sinks import publish
from spoolwire.sources import FileTopic, KafkaTopic, audit_encoding, csv_headers, read_topic, scan_csv
from spoolwire.streaming import emit_records, run_stream, stream_progress, stream_topic

__all__ = [
    "ENVELOPE",
    "PATENT_SCHEMA",
    "DataLossError",
    "EncodingError",
    "FileTopic",
    "HeaderMismatch",
    "KafkaTopic",
    "SourceNotFound",
    "audit_encoding",
    "consume_topic",
    "csv_headers",
    "decode_envelope",
    "decode_strict",
    "describe_schema",
    "drop_empty",
    "emit_records",
    "first_records",
    "head_chars",
    "load_report",
    "locate_bad_utf8",
    "number_records",
    "offset_gaps",
    "parse_any",
    "parse_records",
    "preview",
    "progress",
    "publish",
    "read_topic",
    "run_stream",
    "scan_csv",
    "schema_drift",
    "schema_profile",
    "source_head",
    "stream_progress",
    "stream_topic",
    "string_schema",
    "to_wire",
    "upload_csv",
    "utf8_ok",
    "with_position",
]
