"""Sums of per-task partial results that travel as bytes, merged in two streamed levels.

A partial is a row ``(key, payload)``. Each merging task adds the payloads it
reads one by one, so it holds one sum per key and never a group; at the first
level a key's partials are dealt over ``SPREAD`` tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks of the first level that share one key's partials, and sums held at once before they are passed on.
SPREAD = 16
HELD = 512


def adder(add: Callable, load: Callable, dump: Callable, key_type: pa.DataType, held: int | None = HELD) -> Callable:
    """A ``mapInArrow`` function that adds the payloads of each key; a key may come out more than once if ``held`` is set."""

    def out(sums: dict) -> pa.RecordBatch:
        arrays = [pa.array(list(sums), key_type), pa.array([dump(v) for v in sums.values()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["key", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for key, payload in zip(batch.column("key").to_pylist(), batch.column("payload")):
                value = load(payload.as_py())
                sums[key] = add(sums[key], value) if key in sums else value
                if held and len(sums) >= held:
                    yield out(sums)
                    sums = {}
        if sums:
            yield out(sums)

    return run


def merged(partials: DataFrame, add: Callable, load: Callable, dump: Callable, key: str = "string") -> DataFrame:
    """``(key, payload)``: one row per key with the sum of its partials."""
    arrow = {"string": pa.string(), "int": pa.int32()}[key]
    schema = f"key {key}, payload binary"
    spread = partials.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).repartition("key", "salt")
    few = spread.select("key", "payload").mapInArrow(adder(add, load, dump, arrow), schema)
    return few.repartition("key").mapInArrow(adder(add, load, dump, arrow, None), schema)
