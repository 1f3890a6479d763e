"""Exact centroid clustering of integer vectors, with centroids filtered by an n-simplex projection.

Every vector's distances to a few pivots are measured once. With the pivots
placed as the vertices of a simplex, they turn into the coordinates of an apex
over it: its foot in the space of the simplex, and a height. Two apexes bound
the distance of their vectors: from below by their distance with both heights
on one side, from above with the heights on opposite sides. A centroid whose
lower bound lies above the least upper bound of a vector can't be its nearest
one; the others are compared by exact integer distances. The bounds are
widened by the rounding error of the projection, so the filter never decides.

Vectors and their apexes are written once to the shared folder. A round reads
them, keeps sums per centroid in every task, and adds these up to one row per
centroid, from which the driver divides exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, table

#: The registered query's vectors and rounds.
DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: Most pivots, and the least height of a pivot over those before it, as a share of their largest distance.
PIVOTS = 16
LEAST_HEIGHT = 0.1
#: Components below this size are compared in 64-bit integers, larger ones as Python's.
NARROW = 1 << 27
#: Sums are carried as limbs of 64 bits, the last one signed: enough of them for what floats can hold.
LIMB = 64
COMPONENT_LIMBS, DISTANCE_LIMBS = 2, 5
#: Largest value of a long; longer distances and sums stop there.
MOST = (1 << 63) - 1


def scaled(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles; ``scale`` is a power of two, so nothing is rounded before."""
    return np.floor(values * scale)


def _exact(row: np.ndarray) -> np.ndarray:
    """Integers of any size from whole doubles."""
    return np.array([int(v) for v in row], dtype=object)


class Simplex:
    """Pivots as vertices of a simplex, and the apex coordinates that distances to them give."""

    def __init__(self, candidates: np.ndarray, most: int = PIVOTS):
        """Take the first of the candidates, then always the one highest over the simplex so far."""
        self.pivots = candidates[:1]
        self.vertices = np.zeros((1, 0))
        while 0 < len(self.pivots) < min(most, len(candidates)):
            apex = self.apexes(candidates)
            scale = np.sqrt(((candidates - self.pivots[0]) ** 2).sum(axis=1)).max()
            best = int(apex[:, -1].argmax())
            if not apex[best, -1] > LEAST_HEIGHT * scale:
                break
            self.vertices = np.concatenate([np.pad(self.vertices, ((0, 0), (0, 1))), apex[best : best + 1]])
            self.pivots = np.concatenate([self.pivots, candidates[best : best + 1]])
        base = self.vertices[1:]
        #: Relative rounding error of squared bounds.
        self.error = 1e-13 * (float(np.linalg.cond(base)) ** 2 + len(self.pivots)) if len(base) else 1e-12

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Apex coordinates ``(rows, pivots)`` from the distances to the pivots; the last one is the height."""
        d2 = np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)
        base = self.vertices[1:]
        foot = np.zeros((len(x), 0))
        if len(base):
            right = (d2[:, :1] + (base**2).sum(axis=1) - d2[:, 1:]) / 2
            foot = np.linalg.solve(base, right.T).T
        height = np.sqrt(np.maximum(d2[:, 0] - (foot**2).sum(axis=1), 0))
        return np.concatenate([foot, height[:, None]], axis=1)

    def candidates(self, apex: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """``(rows, centroids)``: whether a centroid can be nearest, by the bounds of squared distances."""
        squares = (apex**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None, :]
        foot = np.maximum(squares - 2 * (apex[:, :-1] @ centroids[:, :-1].T), 0)
        heights = 2 * apex[:, -1:] * centroids[None, :, -1]
        slack = self.error * squares
        return foot - heights - slack <= (foot + heights + slack).min(axis=1)[:, None]


def _nearest(simplex: Simplex, centroids: list[list[int]]):
    """A function ``(vectors, apexes) -> (centroid, exact squared distance)``; ties go to the smaller number."""
    exact = [np.array(c, dtype=object) for c in centroids]
    wide = np.array([max(map(abs, c)) >= NARROW for c in centroids])
    narrow = np.array([[0] * len(c) if w else c for c, w in zip(centroids, wide)], np.int64)
    apexes = simplex.apexes(np.array(centroids, float))

    def run(x: np.ndarray, apex: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = np.nonzero(simplex.candidates(apex, apexes))
        big = np.abs(x).max(axis=1) >= NARROW
        small = np.where(big[:, None], 0, x).astype(np.int64)
        d = ((small[rows] - narrow[cols]) ** 2).sum(axis=1)
        slow = np.flatnonzero(big[rows] | wide[cols])
        if len(slow):
            d = d.astype(object)
            for i in slow:
                d[i] = int(((_exact(x[rows[i]]) - exact[cols[i]]) ** 2).sum())
        # candidates of a row are in ascending order of centroids: the first least one wins
        first = np.searchsorted(rows, np.arange(len(x)))
        least = np.minimum.reduceat(d, first) if len(x) else d
        hit = np.flatnonzero(d == np.repeat(least, np.diff(np.append(first, len(rows)))))
        at = hit[np.searchsorted(rows[hit], np.arange(len(x)))]
        return cols[at], d[at]

    return run


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.array(column.flatten(), float).reshape(-1, width)


def _limbs(v: int, n: int) -> list[Decimal]:
    """``v`` in ``n`` limbs, lowest first."""
    return [Decimal(v >> LIMB * i if i == n - 1 else (v >> LIMB * i) & ((1 << LIMB) - 1)) for i in range(n)]


def _whole(limbs: list[Decimal], n: int) -> list[int]:
    """The integers of every ``n`` summed limbs."""
    return [sum(int(v) << LIMB * i for i, v in enumerate(limbs[at : at + n])) for at in range(0, len(limbs), n)]


_SUMS = "cluster int, n long, distance array<decimal(38,0)>, sums array<decimal(38,0)>"


def _round(shared):
    """Per task and centroid: the number, the summed distance and the summed components of the vectors nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        simplex, centroids = shared.value
        k, width = len(centroids), len(centroids[0])
        nearest = _nearest(simplex, centroids)
        n, distance = [0] * k, [0] * k
        sums = [np.zeros(width, dtype=object) for _ in range(k)]
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            found, d = nearest(x, _matrix(batch.column("apex"), len(simplex.pivots)))
            big = np.abs(x).max(axis=1) >= NARROW
            for c in np.unique(found):
                mine = found == c
                n[c] += int(mine.sum())
                distance[c] += sum(int(v) for v in d[mine])
                sums[c] = sums[c] + x[mine & ~big].astype(np.int64).sum(axis=0).astype(object)
                for row in x[mine & big]:
                    sums[c] = sums[c] + _exact(row)
        held = [c for c in range(k) if n[c]]
        limbs = pa.list_(pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held, pa.int32()),
                pa.array([n[c] for c in held], pa.int64()),
                pa.array([_limbs(distance[c], DISTANCE_LIMBS) for c in held], limbs),
                pa.array([[limb for v in sums[c] for limb in _limbs(int(v), COMPONENT_LIMBS)] for c in held], limbs),
            ],
            ["cluster", "n", "distance", "sums"],
        )

    return run


def _totals(vectors: DataFrame, simplex: Simplex, centroids: list[list[int]]) -> dict[int, tuple[int, int, list[int]]]:
    """``{centroid: (vectors, summed distance, summed components)}``: at most one row per centroid reaches the driver."""
    shared = vectors.sparkSession.sparkContext.broadcast((simplex, centroids))
    partial = vectors.mapInArrow(_round(shared), _SUMS)
    width = COMPONENT_LIMBS * len(centroids[0])
    total = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("distance", F.lit(i))) for i in range(DISTANCE_LIMBS)]).alias("distance"),
        F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"),
    )
    return {r["cluster"]: (r["n"], _whole(r["distance"], DISTANCE_LIMBS)[0], _whole(r["sums"], COMPONENT_LIMBS)) for r in total.collect()}


def _projected(shared, width: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        simplex = shared.value
        for batch in batches:
            x = scaled(_matrix(batch.column("v"), width), scale)
            apex = simplex.apexes(x)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(pa.float64())) for m in (x, apex)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *lists], ["vec_id", "x", "apex"])

    return run


def _assigned(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        simplex, centroids, rows = shared.value
        nearest = _nearest(simplex, centroids)
        inertia = np.array([rows.get(c, (0, ""))[0] for c in range(len(centroids))], np.int64)
        named = np.array([rows.get(c, (0, ""))[1] for c in range(len(centroids))], dtype=object)
        for batch in batches:
            found, d = nearest(_matrix(batch.column("x"), len(centroids[0])), _matrix(batch.column("apex"), len(simplex.pivots)))
            long = [min(int(v), MOST) for v in d] if d.dtype == object else d
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(found, pa.int32()), pa.array(long, pa.int64()), pa.array(inertia[found]), pa.array(named[found], pa.string())],
                ["vec_id", "cluster", "distance", "cluster_inertia", "centroid_sha256"],
            )

    return run


def first_by_hash(vectors: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the smallest sha256 of ``2:<vec_id>``, in that order; rows without an id come last, equal ids by vector."""
    return vectors.orderBy(F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(n)


def usable(v: Column, dimensions: int) -> Column:
    """Exactly ``dimensions`` components, none null or not finite."""
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    return F.coalesce((F.size(v) == dimensions) & F.forall(v, finite), F.lit(False))


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Vectors that are null, of another length, or hold a null or non-finite
    component are left out; each repeated row is a vector of its own, and rows
    without an id are kept but start no cluster unless too few others do. With
    fewer vectors than centroids there are as many centroids as vectors, equal
    ones included (the first of them gets the vectors); without any the result
    is empty. Components are exact integers as far as floats go; squared
    distances and sums beyond a long are compared exactly and shown as its
    largest value.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.transform(F.col(vector), lambda e: e.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(usable(F.col("v"), dimensions))
    start = scaled(np.array([r["v"] for r in first_by_hash(rows, centroids).collect()], float).reshape(-1, dimensions), scale)
    ids = rows.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {ids}, cluster int, distance long, cluster_inertia long, centroid_sha256 string"
    if not len(start):
        return spark.createDataFrame([], f"vec_id {ids}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    simplex = Simplex(start, pivots)
    shared = spark.sparkContext.broadcast(simplex)
    cached = materialize(rows.mapInArrow(_projected(shared, dimensions, scale), f"vec_id {ids}, x array<double>, apex array<double>"), "apexes")
    now = [[int(c) for c in row] for row in start]
    for _ in range(rounds):
        for c, (n, _distance, sums) in _totals(cached, simplex, now).items():
            now[c] = [s // n for s in sums]
    final = _totals(cached, simplex, now)
    hashed = F.sha2(F.col("c"), 256)
    names = spark.createDataFrame([(c, ",".join(map(str, now[c]))) for c in final], "i int, c string").select("i", hashed.alias("h")).collect()
    shown = {r["i"]: (min(final[r["i"]][1], MOST), r["h"]) for r in names}
    total = min(sum(d for _, d, _ in final.values()), MOST)
    done = cached.mapInArrow(_assigned(spark.sparkContext.broadcast((simplex, now, shown))), out)
    return done.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters, distances and inertia of ``embeddings`` after five rounds from forty hashed vectors."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _op13_sql() -> str:
    """Five rounds in plain SQL, one step after the other."""
    steps = [
        """v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS c, x AS y FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= 40)"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT vec_id, x, arg_min(c, d * 64 + c) AS c, min(d) AS d FROM (
    SELECT vec_id, x, c, list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i})
  GROUP BY vec_id, x)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""m{i} AS (
  SELECT c, list(m ORDER BY j) AS y FROM (
    SELECT c, j, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
      SELECT c, j, sum(e)::BIGINT AS s, count(*)::BIGINT AS n FROM (SELECT c, unnest(x) AS e, unnest(range(64)) AS j FROM a{i}) GROUP BY c, j))
  GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.y, c{i}.y) AS y FROM c{i} LEFT JOIN m{i} USING (c))"""
            )
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, c AS "cluster", d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(y, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (c)"""
    )


OP13_SQL = _op13_sql()
