"""Column expressions: wire format, JSON parsing, text checks."""

from spoolwire.functions.codec import MalformedRecord, binary_deserializer, binary_serializer
from spoolwire.functions.envelope import (
    CREATE_TIME,
    ENVELOPE,
    ENVELOPE_COLUMNS,
    LOG_APPEND_TIME,
    decode_envelope,
    decode_strict,
    json_serializer,
    ntz_to_instant,
    stringify,
    to_wire,
    with_position,
)
from spoolwire.functions.json import parse_json_any, parse_json_struct, with_corrupt_field
from spoolwire.functions.text import csv_tokens, head_chars, utf8_ok, utf8_repair, utf8_require

__all__ = [
    "CREATE_TIME",
    "ENVELOPE",
    "ENVELOPE_COLUMNS",
    "LOG_APPEND_TIME",
    "MalformedRecord",
    "binary_deserializer",
    "binary_serializer",
    "csv_tokens",
    "decode_envelope",
    "decode_strict",
    "head_chars",
    "json_serializer",
    "ntz_to_instant",
    "parse_json_any",
    "parse_json_struct",
    "stringify",
    "to_wire",
    "utf8_ok",
    "utf8_repair",
    "utf8_require",
    "with_corrupt_field",
    "with_position",
]
