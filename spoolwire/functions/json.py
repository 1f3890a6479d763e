"""JSON parsing expressions: declared-schema (``from_json``) and schemaless (``VARIANT``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("permissive", "strict")


def with_corrupt_field(schema: T.StructType, corrupt_column: str) -> T.StructType:
    """Append a string field that receives the raw text of unparsable records."""
    if corrupt_column in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])


def parse_json_struct(
    col: Column | str,
    schema: T.StructType,
    corrupt_column: str | None = None,
    mode: str = "permissive",
) -> Column:
    """JSON text -> struct of ``schema``.

    Permissive: missing fields are null, unknown fields dropped, the last of
    duplicate keys wins, malformed or non-object input gives a struct of nulls
    (and its raw text in ``corrupt_column`` when one is named). Null or empty
    input gives a null struct. Strict: the query fails on malformed input.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    options = {"mode": "FAILFAST" if mode == "strict" else "PERMISSIVE"}
    if corrupt_column and mode == "permissive":
        schema = with_corrupt_field(schema, corrupt_column)
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(col, schema, options)


def parse_json_any(col: Column | str, mode: str = "permissive") -> Column:
    """JSON text -> ``VARIANT`` with no declared schema.

    Permissive gives null for malformed text (and for duplicate keys);
    strict fails the query.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return F.parse_json(col) if mode == "strict" else F.try_parse_json(col)
