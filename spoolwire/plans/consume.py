"""Topic -> typed records: bounded read, decode, parse by a declared schema, flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spoolwire.functions.envelope import decode_envelope
from spoolwire.operators.records import parse_records
from spoolwire.sources.topic import Topic, read_topic


def consume_topic(
    spark: SparkSession,
    topic: Topic,
    schema: T.StructType,
    *,
    starting="earliest",
    ending="latest",
    fail_on_data_loss: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """``key`` plus one string column per declared field, for every record in range.

    Works the same on a streaming envelope (see ``stream_topic``).
    """
    envelope = decode_envelope(read_topic(spark, topic, starting, ending, fail_on_data_loss))
    return parse_records(envelope, schema, keep=("key",), corrupt_column=corrupt_column)
