import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spoolwire.llm import centroids


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(now))[::-1]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[0], []).append(v)
        for j, members in groups.items():
            now[j] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = {}
    for _, j, d in found:
        inertia[j] = inertia.get(j, 0) + d
    total, most = sum(inertia.values()), (1 << 63) - 1
    sha = lambda j: hashlib.sha256(",".join(map(str, now[j])).encode()).hexdigest()
    return sorted(((i, j, min(d, most), min(inertia[j], most), min(total, most), sha(j)) for i, j, d in found), key=repr)


def run(spark, rows, k, rounds, dims, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("v", F.lit(1))
    got = centroids.cluster(df.repartition(5), k, rounds, dims, **options).collect()
    return sorted(map(tuple, got), key=repr)


def blobs(n, dims, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(9, dims))
    v = np.round(c[rng.integers(0, 9, n)] + spread * rng.normal(size=(n, dims)), 3).astype(np.float32)
    return [(i, [float(x) for x in r]) for i, r in enumerate(v)]


@pytest.mark.parametrize("pivots", [1, 3, 16])
def test_against_brute_force(spark, pivots):
    rows = blobs(400, 8, pivots)
    assert run(spark, rows, 12, 3, 8, pivots=pivots) == brute(rows, 12, 3, 8)


def test_ties_repeats_and_unusable_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [float(i % 3), 0.0, -0.001]) for i in range(60)] + [(5, [2.0, 0.0, 0.5])] * 3 + [(None, [1.0, 1.0, 1.0])] * 2
    bad = [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0]), (94, [inf, 0.0, 0.0]), (95, [nan, 0.0, 0.0]), (96, [1.0] * 4)]
    assert run(spark, rows + bad, 7, 2, 3) == brute(rows + bad, 7, 2, 3)
    assert run(spark, rows[:4], 40, 5, 3) == brute(rows[:4], 40, 5, 3)
    assert run(spark, [(1, [0.0, 0.0, 0.0])] * 30, 5, 2, 3) == brute([(1, [0.0, 0.0, 0.0])] * 30, 5, 2, 3)
    assert run(spark, bad, 5, 2, 3) == []


def test_values_beyond_64_bits_are_exact(spark):
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(3e38 * (-1) ** i / (1 + i % 4)), f(1e9 * i), 0.25]) for i in range(20)] + [(100 + i, [0.5 * i, 1.0, 2.0]) for i in range(20)]
    rows += [(200 + i, [f(600_000.0 + i), 1.0, f(-524_288.5)]) for i in range(6)]
    assert run(spark, rows, 9, 3, 3) == brute(rows, 9, 3, 3)


def test_bounds_hold_and_filter(spark):
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.array([v for _, v in blobs(600, 16, 5, 0.05)]))
    simplex = centroids.Simplex(x[:40])
    assert 2 <= len(simplex.pivots) <= centroids.PIVOTS
    c = x[rng.choice(600, 20, replace=False)]
    a, b = simplex.apexes(x), simplex.apexes(c)
    true = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    foot = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    lower, upper = foot + (a[:, None, -1] - b[None, :, -1]) ** 2, foot + (a[:, None, -1] + b[None, :, -1]) ** 2
    assert (lower <= true * (1 + 1e-9) + 1e-3).all() and (upper >= true * (1 - 1e-9) - 1e-3).all()
    can = simplex.candidates(a, b)
    assert can[np.arange(600), true.argmin(axis=1)].all() and can.mean() < 0.5
