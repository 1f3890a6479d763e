import zlib

import numpy as np
import pyarrow as pa
from llm_helpers import docs_table
from pyspark.sql import functions as F

from spoolwire.llm import quality
from spoolwire.llm.common import utf8

SF = "/root/testdata/sf0.01"


def stats(*texts):
    return quality.statistics(*utf8(pa.array(texts, pa.string())))


def test_statistics_by_hand():
    texts = ["One two two.\nOne two two.\n\n9 | é", "", None, "x", " \n\t ", "Über " * 50_000]
    got = {k: stats(*texts)[:, i] for i, k in enumerate(quality.STATISTICS)}
    assert np.isclose(got["log_words"][0], np.log1p(9))
    words = "One two two. One two two. 9 | é".split()
    assert np.isclose(got["distinct_words"][0], len({w.lower() for w in words}) / len(words))
    assert np.isclose(got["top_word"][0], 2 / 9) and np.isclose(got["lines_per_word"][0], 3 / 9)
    assert np.isclose(got["distinct_lines"][0], 2 / 3) and np.isclose(got["wordless"][0], 2 / 9)
    size = len(texts[0].encode())
    assert np.isclose(got["capitals"][0], 2 / size) and np.isclose(got["digits"][0], 1 / size) and np.isclose(got["wide"][0], 1 / size)
    for i in (1, 2):
        assert all(v[i] == 0 for v in got.values())
    assert np.isclose(got["distinct_words"][5], 1 / 50_000)
    alone = stats(texts[0])[0]
    assert np.allclose(alone, stats(*texts)[0]) and stats().shape == (0, len(quality.STATISTICS))


def test_normal_equations_equal_a_direct_fit(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 3] > 0).astype(int)
    rows = spark.createDataFrame([(list(map(float, r)), int(v), i % 4) for i, (r, v) in enumerate(zip(x, y))], "x array<double>, y int, fold int")
    model = quality.fit(rows.repartition(7))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.deviation, x.std(axis=0))
    f = model.features(x)
    assert np.allclose(model.beta, quality.solve(f.T @ f, f.T @ y, len(y)), atol=1e-6)
    assert (np.diff(model.values) >= 0).all() and (np.diff(model.knots) > 0).all()


def test_features_approximate_the_kernel():
    model = quality.QualityModel(np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)), features=20_000)
    a = np.random.default_rng(1).normal(size=(2, len(quality.STATISTICS)))
    f = model.features(a)[:, :-1]
    width = quality.WIDTH * np.sqrt(len(quality.STATISTICS))
    assert abs(f[0] @ f[1] - np.exp(-((a[0] - a[1]) ** 2).sum() / (2 * width**2))) < 0.03


def test_isotonic_against_every_split():
    rng = np.random.default_rng(2)
    for _ in range(20):
        n = rng.integers(1, 30, 12).astype(float)
        p = np.minimum(n, rng.integers(0, 30, 12))
        x = np.arange(12.0)
        knots, values = quality.isotonic(x, p, n)
        assert (np.diff(values) >= 0).all() and ((values > 0) & (values < 1)).all() and len(knots) == len(values)
        # min-max formula of the isotonic fit, whose pools the knots are
        share = lambda i, j: p[i : j + 1].sum() / n[i : j + 1].sum()
        want = np.array([max(min(share(i, j) for j in range(k, 12)) for i in range(k + 1)) for k in range(12)])
        assert len(knots) == len(np.unique(np.round(want, 12)))


def test_held_out_quality(spark):
    got = {r["doc_id"]: r for r in quality.op12_quality(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    said = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(y, r) for y, r in said if r["held_out"]]
    assert np.mean([y == r["predicted"] for y, r in held]) > 0.95
    low, high = ([r["score"] for y, r in held if y == k] for k in (0, 1))
    assert np.mean([h > x for h in high for x in low]) > 0.97


def test_hard_rows(spark):
    rows = [(i, "good words here and there, " * (1 + i % 5) if i % 2 else "## $$ || " * (1 + i % 4), None, None) for i in range(300)]
    rows += [(300, None, None, None), (300, "", None, None), (None, "x", None, None), (301, "y " * 200_000, None, None)]
    docs = docs_table(spark, rows).withColumn("x", F.lit("clash")).withColumn("id", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(4, None), (5, 7), (None, 1), (300, 0), (300, 0)], "doc_id long, quality int")
    st = quality.document_statistics(docs)
    model = quality.fit(quality.training_rows(st, labels))
    out = quality.classify(st, model).collect()
    assert len(out) == len(rows)
    by = {r["id"]: r["score"] for r in out}
    assert np.mean([by[i] > 0.5 for i in range(1, 300, 2)]) > 0.95 and np.mean([by[i] < 0.5 for i in range(0, 300, 2)]) > 0.95
    again = quality.classify(st, model).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    none = quality.fit(quality.training_rows(st, labels.where("doc_id < 0")))
    assert {r["score"] for r in quality.classify(st, none).collect()} == {0.5}
    one = quality.fit(quality.training_rows(st, labels.where("quality = 1")))
    assert all(r["score"] > 0.5 for r in quality.classify(st, one).collect())
    empty = quality.document_statistics(docs.where("false"))
    assert quality.classify(empty, model).count() == 0
