"""A binary record format that Spark has no built-in for: a serializer as Arrow UDF, a deserializer of Spark's functions.

A record is its fields in order, each a 4-byte big-endian signed length and
that many bytes of UTF-8; length -1 is a null field. The pair fits
``publish(serializer=)``, ``deserialize`` and ``decode_records(deserializer=)``,
batch and streaming; reading a topic runs no Python. ``encode_records`` and
``decode_records_binary`` do the same to Arrow arrays, without a loop over rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_LENGTH = -1


class MalformedRecord(ValueError):
    """A value is not a record of the declared fields."""


def encode_records(records: pa.StructArray) -> pa.Array:
    """The bytes of every record of string fields; a null record gives null."""
    parts = []
    for i, field in enumerate(records.type):
        if not (pa.types.is_string(field.type) or pa.types.is_large_string(field.type)):
            raise TypeError(f"field {field.name} is {field.type}, not a string: cast it first")
        text = records.field(i).cast(pa.large_string())
        sizes = pc.fill_null(pc.binary_length(text), NULL_LENGTH).to_numpy(zero_copy_only=False)
        if len(sizes) and sizes.max() >= 1 << 31:
            raise ValueError(f"field {field.name} has a value of 2 GB or more")
        heads = pa.Array.from_buffers(pa.binary(4), len(sizes), [None, pa.py_buffer(sizes.astype(">i4").tobytes())])
        parts += [heads.cast(pa.binary()).cast(pa.large_binary()), pc.fill_null(text.cast(pa.large_binary()), b"")]
    empty = pa.scalar(b"", pa.large_binary())
    if parts:
        out = pc.binary_join_element_wise(*parts, empty)
    else:
        out = pa.array([b""] * len(records), pa.large_binary())
    return pc.if_else(records.is_valid(), out, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def _valid_texts(texts: pa.Array) -> np.ndarray:
    """Which of the binary values are UTF-8."""
    try:
        texts.cast(pa.large_string())
        return np.ones(len(texts), bool)
    except pa.ArrowInvalid:
        if len(texts) == 1:
            return np.zeros(1, bool)
    half = len(texts) // 2
    return np.concatenate([_valid_texts(texts[:half]), _valid_texts(texts[half:])])


def decode_records_binary(values: pa.Array, names: Sequence[str], failfast: bool = False) -> pa.StructArray:
    """Records of the string fields ``names``; a null value gives null.

    A value that ends early, goes on after the last field, has a length below
    -1 or holds text that isn't UTF-8 gives null, or fails with ``failfast``.
    """
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    n = len(values)
    off = np.frombuffer(offsets, np.int64)[values.offset : values.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    given = values.is_valid().to_numpy(zero_copy_only=False)
    at, end, good = off[:-1].copy(), off[1:], given.copy()
    fields = []
    for _ in names:
        good &= at + 4 <= end
        size = np.full(n, NULL_LENGTH, np.int64)
        here = at[good]
        size[good] = np.stack([raw[here + k] for k in range(4)], axis=1).reshape(-1).view(">i4")
        good &= (size >= NULL_LENGTH) & (at + 4 + size <= end)
        start, size = at + 4, np.where(good, size, NULL_LENGTH)
        fields.append((start, size))
        at = np.where(good, start + np.maximum(size, 0), at)
    good &= at == end
    columns = []
    for start, size in fields:
        length = np.where(good, np.maximum(size, 0), 0)
        bounds = np.concatenate([[0], np.cumsum(length)])
        bytes_ = raw[np.repeat(start - bounds[:-1], length) + np.arange(bounds[-1])]
        columns.append(pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(bytes_.tobytes())]))
    for column in columns:
        good &= _valid_texts(column)
    if failfast and (given & ~good).any():
        raise MalformedRecord(f"{int((given & ~good).sum())} values are not records of {len(names)} fields")
    texts = [
        pc.if_else(pa.array(good & (size >= 0)), column, pa.scalar(None, pa.large_binary())).cast(pa.large_string()).cast(pa.string())
        for column, (_, size) in zip(columns, fields, strict=True)
    ]
    return pa.StructArray.from_arrays(texts, list(names), mask=pa.array(~good))


def binary_serializer(record: Column) -> Column:
    """Record struct of strings -> its bytes."""

    @F.arrow_udf(T.BinaryType())
    def encode(records: pa.Array) -> pa.Array:
        return encode_records(records)

    return encode(record)


def binary_deserializer(names: Sequence[str], failfast: bool = False) -> Callable[[Column], Column]:
    """Bytes -> struct of the string fields ``names``; see :func:`decode_records_binary` for malformed values."""
    names = list(names)

    def decode(value: Column) -> Column:
        value = value.cast("binary")  # of a column read as text too

        def field(state: Column, _: Column) -> Column:
            at = state["at"]
            size = F.conv(F.hex(F.substr(value, at, F.lit(4))), 16, 10).cast("long")
            size = F.when(size >= 1 << 31, size - (1 << 32)).otherwise(size)
            text = F.substr(value, at + 4, size.cast("int")).cast("string")
            fits = (at + 3 <= F.octet_length(value)) & (size >= NULL_LENGTH) & (at + 3 + size <= F.octet_length(value))
            given = state["good"] & fits & (size >= 0)
            good = state["good"] & fits & F.when(given, F.is_valid_utf8(text)).otherwise(True)
            after = F.when(good, at + 4 + F.greatest(size, F.lit(0)).cast("int")).otherwise(at)
            return F.struct(after.alias("at"), good.alias("good"), F.concat(state["texts"], F.array(F.when(given, text))).alias("texts"))

        def record(state: Column) -> Column:
            whole = state["good"] & (state["at"] == F.octet_length(value) + 1)
            fields = F.struct(*[state["texts"][i].alias(c) for i, c in enumerate(names)])
            bad = F.raise_error(F.lit(f"a value is not a record of {len(names)} fields")) if failfast else F.lit(None)
            return F.when(whole, fields).otherwise(bad)

        start = F.struct(F.lit(1).alias("at"), F.lit(True).alias("good"), F.array().cast("array<string>").alias("texts"))
        return F.when(value.isNotNull(), F.aggregate(F.array(*[F.lit(i) for i in range(len(names))]), start, field, record))

    return decode
