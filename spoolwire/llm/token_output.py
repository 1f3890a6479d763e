"""Token ids of a corpus in Re-Pair shards, in ascending id order.

Documents are range-partitioned by id and sorted; each task encodes its
texts, packs runs of about ``SHARD_IDS`` ids into shards (``repair``) and
writes them as rows of a Parquet table, so the committer of that table makes
them safe against lost executors and repeated attempts. A shard row also
holds its place (task, number within the task) and the documents' ids, and can
be decoded by itself, in whole or in part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..workspace import scratch_path
from .common import bounded_batches, materialize, release_memory, table, utf8
from .repair import Shard, pack
from .token_units import UnitEncoder

#: Ids of a shard, about; and the id that ends each document.
SHARD_IDS = 1 << 20
END_ID = 0
SHARD_SCHEMA = "part int, number int, n_ids long, doc_ids array<long>, blob binary"
_ENCODERS: dict[str, UnitEncoder] = {}


def default_tokenizer() -> str:
    """The public byte-level BPE file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _write(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or default_tokenizer()
        encoder = _ENCODERS.setdefault(file, None) or UnitEncoder(file)  # kept by the worker for its next tasks
        _ENCODERS[file] = encoder
        base = encoder.tok.get_vocab_size(with_added_tokens=True)
        part, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids = np.concatenate(held)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            row = [[part], [number], [len(ids)], [names], [pack(ids, bounds, base)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "number", "n_ids", "doc_ids", "blob"])

        for batch in batches:
            ids, bounds = encoder.encode(*utf8(batch.column(1)))
            for i, name in enumerate(batch.column(0).to_pylist()):
                held.append(np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(END_ID)))
                names.append(name)
                size += len(held[-1])
                if size >= SHARD_IDS:
                    yield shard()
                    held, names, size, number = [], [], 0, number + 1
            del ids
        if held:
            yield shard()
        held.clear()
        release_memory()

    return run


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> None:
    """Encode all texts and write their shards to ``path``.

    Null texts are empty; every document ends with ``END_ID``. Documents
    without an id come first; rows that share an id follow each other by the
    hash of their text, and equal rows are all kept. An empty table writes no
    shard. A text longer than a shard makes a longer shard.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    rows.mapInArrow(_write(tokenizer), SHARD_SCHEMA).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, names, blob in zip(*(batch.column(c) for c in ("part", "number", "doc_ids", "blob")), strict=True):
            shard = Shard(blob.as_buffer())
            ids, bounds = shard.ids().astype("<u4"), shard.doc_bounds.tolist()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.as_py()] * n, pa.int32()), pa.array([number.as_py()] * n, pa.int32()), names.values, pa.array(bounds[:-1], pa.int64()), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())],
                ["part", "number", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for names, blob in zip(batch.column("doc_ids"), batch.column("blob"), strict=True):
            shard = Shard(blob.as_buffer())
            for i, name in enumerate(names.as_py()):
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([shard.document(i).astype(np.int32)], pa.list_(pa.int32()))], ["doc_id", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, ids)`` of every document in the shards, its end id included."""
    bounded_batches(spark, rows=4)
    return spark.read.schema(SHARD_SCHEMA).parquet(path).select("doc_ids", "blob").mapInArrow(_decoded, "doc_id long, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the shards.

    ``start`` counts the ids of all documents before it: a sum within the
    shard, plus sums over shards (by task) and over tasks.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = materialize(shards.select("part", "number", "n_ids"), "shard-sizes")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per writing task
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    places = sizes.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("offset")).join(parts, "part")
    bounded_batches(spark, rows=4)
    docs = shards.select("part", "number", "doc_ids", "blob").mapInArrow(
        _digests, "part int, number int, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return docs.join(places, ["part", "number"]).select("doc_id", (F.col("base") + F.col("offset") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def write_and_digest(docs: DataFrame, label: str = "token-shards") -> DataFrame:
    """Write ``docs`` to new shards in the shared folder and read their digests back."""
    spark = docs.sparkSession
    path = scratch_path(spark, label)
    write_shards(docs, path)
    return read_digests(spark, path)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from its shard."""
    return write_and_digest(table(spark, sf_dir, "documents"))
