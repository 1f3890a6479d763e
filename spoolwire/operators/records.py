"""Record-level operators: empty-record filter, declared-schema and schemaless parsing.

All are narrow (no shuffle) and work unchanged on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwire.functions.json import parse_json_any, parse_json_struct
from spoolwire.sources.csv import OVERFLOW, csv_headers

PARSED = "parsed_value"


def non_empty(df: DataFrame, columns: Sequence[str] | None = None, keep_overlong: bool = True) -> Column:
    """True for records with at least one non-empty field (whitespace counts as content).

    With ``keep_overlong`` a row carrying overflow fields counts as non-empty
    even when all its fields are blank.
    """
    cols = list(columns) if columns is not None else (csv_headers(df) or [c for c in df.columns if c != OVERFLOW])
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) != F.lit(""))
    if keep_overlong and OVERFLOW in df.columns:
        cond = cond | F.coalesce(F.size(OVERFLOW) > 0, F.lit(False))
    return cond


def drop_empty(df: DataFrame, columns: Sequence[str] | None = None, keep_overlong: bool = True) -> DataFrame:
    """Drop records whose fields are all null or ``''``.

    Not ``dropna(how='all')``: that keeps rows of empty strings.
    """
    return df.filter(non_empty(df, columns, keep_overlong))


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = F.col(f"`{name}`")
    return col.cast("string") if isinstance(dtype, T.BinaryType) else col


def parse_records(
    df: DataFrame,
    schema: T.StructType,
    *,
    column: str = "value",
    keep: Sequence[str] = ("key",),
    corrupt_column: str | None = None,
    mode: str = "permissive",
) -> DataFrame:
    """Parse JSON records into typed columns: ``keep`` columns, then one column per schema field.

    Binary ``column``/``keep`` columns (an envelope) are read as UTF-8 text.
    ``corrupt_column`` adds a column holding the raw text of records that are
    not JSON objects (null for good records, also for ``{}``).
    """
    fields = schema.fieldNames() + ([corrupt_column] if corrupt_column else [])
    clash = set(keep) & set(fields)
    if clash:
        raise ValueError(f"kept columns clash with parsed fields: {sorted(clash)}")
    parsed = parse_json_struct(_as_text(df, column), schema, corrupt_column, mode)
    kept = [_as_text(df, k).alias(k) for k in keep]
    return df.select(*kept, parsed.alias(PARSED)).select(*[F.col(f"`{k}`") for k in keep], f"{PARSED}.*")


def split_quarantine(parsed: DataFrame, corrupt_column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) halves of a :func:`parse_records` result that kept a corrupt column."""
    bad = F.col(corrupt_column).isNotNull()
    return parsed.filter(~bad).drop(corrupt_column), parsed.filter(bad)


def parse_any(df: DataFrame, column: str = "value", mode: str = "permissive", alias: str = "json") -> DataFrame:
    """Add a ``VARIANT`` column holding ``column`` parsed as JSON with no declared schema."""
    return df.withColumn(alias, parse_json_any(_as_text(df, column), mode))


def deserialize(df: DataFrame, deserializer, column: str = "value", alias: str = "record") -> DataFrame:
    """Apply a user value deserializer (``Column -> Column``) to the envelope's bytes."""
    return df.withColumn(alias, deserializer(F.col(f"`{column}`")))
