"""DataFrame -> DataFrame operators."""

from spoolwire.operators.drift import record_fields, schema_drift
from spoolwire.operators.locate import locate_bad_utf8
from spoolwire.operators.records import deserialize, drop_empty, non_empty, parse_any, parse_records, split_quarantine
from spoolwire.operators.report import (
    describe_schema,
    first_records,
    load_report,
    observe_counts,
    offset_gaps,
    preview,
    progress,
    schema_profile,
)
from spoolwire.operators.source_order import number_records, source_head

__all__ = [
    "describe_schema",
    "deserialize",
    "drop_empty",
    "first_records",
    "load_report",
    "locate_bad_utf8",
    "non_empty",
    "number_records",
    "observe_counts",
    "offset_gaps",
    "parse_any",
    "parse_records",
    "preview",
    "progress",
    "record_fields",
    "schema_drift",
    "schema_profile",
    "source_head",
    "split_quarantine",
]
