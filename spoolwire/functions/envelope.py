"""The topic record envelope and the record <-> wire conversions.

A topic record is the public Spark-Kafka source row: ``key`` and ``value``
are bytes, the rest says where the record sits in the log. Both topic
backends (Kafka and files) produce exactly this schema, so every operator
downstream is backend-blind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]

# Kafka timestamp types: the producer's create time or the broker's append time.
CREATE_TIME = 0
LOG_APPEND_TIME = 1

Serializer = Callable[[Column], Column]


def json_serializer(record: Column) -> Column:
    """Record struct -> UTF-8 JSON bytes; nulls written as JSON null, non-ASCII kept as is."""
    return F.to_json(record, {"ignoreNullFields": "false"}).cast("binary")


def wire_value(columns: Sequence[str], serializer: Serializer | None = None, optional: Sequence[str] = ()) -> Column:
    """The bytes of a record of ``columns``; ``optional`` columns are part of it only where one isn't null."""
    write = serializer or json_serializer
    field = lambda c: F.col(f"`{c}`")
    plain = write(F.struct(*[field(c) for c in columns])).cast("binary")
    if not optional:
        return plain
    some = F.lit(False)
    for c in optional:
        some = some | field(c).isNotNull()
    return F.when(some, write(F.struct(*[field(c) for c in [*columns, *optional]])).cast("binary")).otherwise(plain)


def to_wire(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    key_column: str | None = None,
    serializer: Serializer | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """Turn record rows into ``key, value`` byte pairs.

    ``columns`` defaults to every column; ``key`` is null unless
    ``key_column`` names one (the reference never sets a key).
    ``serializer`` maps the record struct to a string or binary column.
    """
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in optional]
    value = wire_value(cols, serializer, optional)
    key = F.col(f"`{key_column}`").cast("string").cast("binary") if key_column else F.lit(None).cast("binary")
    return df.select(key.alias("key"), value.alias("value"))


def decode_envelope(df: DataFrame) -> DataFrame:
    """``CAST(key AS STRING), CAST(value AS STRING)``, keeping the names.

    Invalid UTF-8 passes through unchanged; use :func:`decode_strict` or
    ``audit`` functions to catch it.
    """
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def decode_strict(col: Column | str) -> Column:
    """Strict UTF-8 decode: the query fails on the first malformed byte sequence."""
    return F.decode(col, "UTF-8")


def with_position(df: DataFrame, strict: bool = False) -> DataFrame:
    """Record position and payload as text: ``partition, offset, key, value``."""
    dec = decode_strict if strict else (lambda c: F.col(c).cast("string"))
    return df.select(
        "partition",
        "offset",
        dec("key").alias("key"),
        dec("value").alias("value"),
    )


def stringify(df: DataFrame) -> DataFrame:
    """Every column cast to string, the shape a header-derived CSV scan yields."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def ntz_to_instant(col: Column | str) -> Column:
    """Read a TIMESTAMP_NTZ wall-clock value as a UTC instant, whatever the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.timestamp_micros(micros)
