"""Sources: CSV files and topics (bounded reads)."""

from spoolwire.sources.csv import audit_encoding, csv_header, csv_headers, line_safe, scan_csv
from spoolwire.sources.topic import (
    EARLIEST,
    LATEST,
    FileTopic,
    KafkaTopic,
    check_no_data_loss,
    create_topic,
    end_offsets,
    missing_ranges,
    read_topic,
    topic_partitions,
)

__all__ = [
    "EARLIEST",
    "LATEST",
    "FileTopic",
    "KafkaTopic",
    "audit_encoding",
    "check_no_data_loss",
    "create_topic",
    "csv_header",
    "csv_headers",
    "end_offsets",
    "line_safe",
    "missing_ranges",
    "read_topic",
    "scan_csv",
    "topic_partitions",
]
