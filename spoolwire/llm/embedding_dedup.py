"""Near-duplicate embeddings by Euclidean p-stable hashing with exact cosine checks.

Normalised vectors are hashed in several tables; a table's hash is a number of
Gaussian projections, each shifted and cut into steps of ``STEP_WIDTH``. The
number of projections grows with the logarithm of the row count (so buckets
stay small), and the number of tables follows so that a pair at the threshold
is missed by all of them with a chance of at most ``MISS``.

Equal vectors collapse into classes first. Buckets hold ids only until those
with one class are gone; then each bucket is compared as a matrix product in
double precision, and a pair counts in the first table where it meets. A
bucket gives its classes' link counts and a spanning forest, never its pairs.
Buckets over ``BLOCK`` classes are cut into blocks, one unit per pair of
blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import bounded_batches, materialize, table
from .components import components

COSINE = 0.98
STEP_WIDTH = 1.2
MISS = 1e-5
BLOCK = 1500
SEED = 11
_ROWS = 128


def _meet(distance: float, width: float) -> float:
    """Chance that one projection puts two vectors of this distance into one step."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, cosine: float = COSINE, width: float = STEP_WIDTH, miss: float = MISS) -> tuple[int, int]:
    """``(projections, tables)`` for so many rows."""
    near, far = _meet(math.sqrt(2 - 2 * cosine), width), _meet(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log1p(-(near**k)))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, vectors)`` of the usable vectors, by dimension."""
    valid = np.asarray(column.is_valid())
    at = np.asarray(column.offsets)
    n = np.where(valid, np.diff(at), 0)
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    for dim in np.unique(n[n > 0]):
        rows = np.flatnonzero(n == dim)
        x = flat[at[rows][:, None] + np.arange(dim)]
        ok = np.isfinite(x).all(axis=1)
        rows, x = rows[ok], x[ok]
        big = np.abs(x).max(axis=1, initial=0.0)
        rows, x, big = rows[big > 0], x[big > 0], big[big > 0]
        if len(rows):
            yield rows, x


def normalised(x: np.ndarray) -> np.ndarray:
    """Unit vectors, scaled first so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(k: int, tables: int, width: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            n = len(batch)
            f1, f2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            dims, codes = np.zeros(n, np.int64), np.zeros((n, tables), np.int32)
            labelled = np.asarray(batch.column("label").is_valid())
            for rows, x in _matrices(batch.column("embedding")):
                dim = x.shape[1]
                if dim not in drawn:
                    rng = np.random.default_rng([seed, dim])
                    drawn[dim] = rng.standard_normal((dim, tables * k)), rng.random(tables * k) * width
                a, b = drawn[dim]
                steps = np.floor((normalised(x) @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(x), tables, k)
                mult = words.mix(np.arange(1, k + 1, dtype=np.uint64) * words._C1) | np.uint64(1)
                codes[rows] = (words.mix((steps * mult).sum(axis=2)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                dims[rows] = dim
                bits = (x + 0.0).view(np.uint64)  # equal vectors have equal bits
                mult = words.mix(np.arange(1, dim + 1, dtype=np.uint64) * words._C2) | np.uint64(1)
                f1[rows] = words.mix((words.mix(bits) * mult).sum(axis=1))
                f2[rows] = words.mix((words.mix(bits ^ words._C3) * mult).sum(axis=1))
            dims[~labelled] = 0
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, n * tables + 1, tables), pa.int32()), pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(dims), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), flat, batch.column("embedding")],
                ["vec_id", "label", "dim", "f1", "f2", "codes", "embedding"],
            )

    return run


def _compare(cosine: float):
    """Units of rows sorted by bucket and pair of blocks: each class's newly found links, and a class it hangs on."""

    def unit(rows: list) -> pa.RecordBatch | None:
        t, i, j, block, node, size, codes, x = rows
        x = normalised(x)
        n, t, across = len(node), int(t[0]), i[0] != j[0]
        links, root = np.zeros(n, np.int64), np.arange(n)
        left, right = [], []
        for lo in range(0, n, _ROWS):
            sim = x[lo : lo + _ROWS] @ x[lo:].T
            p, q = np.nonzero(sim >= cosine)
            p, q = p + lo, q + lo
            ok = p < q
            if across:
                ok &= block[p] != block[q]
            p, q = p[ok], q[ok]
            if t and len(p):  # met in an earlier table
                new = ~(codes[p, :t] == codes[q, :t]).any(axis=1)
                p, q = p[new], q[new]
            np.add.at(links, p, size[q])
            np.add.at(links, q, size[p])
            left.append(p), right.append(q)
        p, q = np.concatenate(left), np.concatenate(right)
        if not len(p):
            return None
        while True:  # smallest row number within reach
            low = np.minimum(root[p], root[q])
            before = root.copy()
            np.minimum.at(root, p, low)
            np.minimum.at(root, q, low)
            root = root[root]
            if (root == before).all():
                break
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(node[root])], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None
        for batch in batches:
            if not len(batch):
                continue
            keys = [batch.column(c).to_numpy() for c in ("t", "label", "dim", "code", "i", "j", "block", "node", "size")]
            codes = np.stack(batch.column("codes").to_numpy(zero_copy_only=False))
            vectors = batch.column("embedding").to_numpy(zero_copy_only=False)
            rows = [*keys, codes, vectors]
            if held is not None:
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows, strict=True)]
            change = np.zeros(len(rows[0]) - 1, bool)
            for key in rows[:6]:
                change |= key[1:] != key[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if (out := unit(piece(rows, lo, hi))) is not None:
                    yield out
            held = [r[cuts[-1] :] for r in rows]
        if held is not None and (out := unit(piece(held, 0, len(held[0])))) is not None:
            yield out

    def piece(rows: list, lo: int, hi: int) -> list:
        t, _, _, _, i, j, block, node, size, codes, vectors = (r[lo:hi] for r in rows)
        return [t, i, j, block, node, size, codes, np.stack([np.asarray(v, np.float64) for v in vectors])]

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Vectors with equal non-null labels and dimensions link from ``cosine`` on.
    Null, empty and zero vectors, those with a null or non-finite component,
    and those without a label or an id link with nothing. Rows that share an
    id are one node of a component. Only the named columns are read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, rows=1024)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("embedding"))
    k, tables = plan(rows.count(), cosine)
    schema = "vec_id long, label long, dim long, f1 long, f2 long, codes array<int>, embedding array<double>"
    hashed = rows.mapInArrow(_hashed(k, tables, STEP_WIDTH, SEED), schema)
    hashed = hashed.withColumn("dim", F.when(F.col("vec_id").isNull(), 0).otherwise(F.col("dim")).cast("long"))
    key = ["label", "dim", "f1", "f2"]
    usable = F.col("dim") > 0
    # one row per class of equal vectors; embeddings as stored, codes as hashed
    slim = materialize(hashed.select("vec_id", *key), "vec-classes")
    classes = materialize(
        hashed.where(usable).groupBy(*key).agg(F.min("vec_id").alias("node"), F.count("*").alias("size"), F.first("codes").alias("codes"), F.first("embedding").alias("embedding")), "vectors"
    )
    buckets = classes.select("node", "label", "dim", F.posexplode("codes").alias("t", "code"))
    shared = buckets.groupBy("t", "label", "dim", "code").agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    members = buckets.join(shared.withColumn("blocks", blocks), ["t", "label", "dim", "code"])
    members = members.withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("t", "label", "dim", "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")
    full = members.join(classes.select("node", "label", "dim", "size", "codes", "embedding"), ["node", "label", "dim"])
    unit = ["t", "label", "dim", "code", "i", "j"]
    full = full.select(*unit, "block", "node", "size", "codes", "embedding").repartition(*unit).sortWithinPartitions(*unit)
    found = materialize(full.mapInArrow(_compare(cosine), "node long, links long, root long"), "vec-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = classes.select(*key, "node", "size").join(counts, "node", "left").join(comps, "node", "left")
    named = named.select(*key, "size", "links", F.coalesce("component", "node").alias("component"))
    out = slim.join(named, key, "left")
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("size") - 1, F.lit(0))
    out = out.select("vec_id", links.cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP3_SQL = r"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
k AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
c AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, k.component_id, e.vec_id = k.component_id AS kept
FROM embeddings e JOIN k USING (vec_id) LEFT JOIN c USING (vec_id)
"""
