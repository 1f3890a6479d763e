"""Quality scores: random Fourier features of document statistics, ridge by summed normal equations, isotonic calibration.

A text becomes a fixed list of statistics (lengths, shares of character
classes, repetition of words, shingles and lines), standardised by their mean
and deviation over the training rows. Cosines of random projections of them
approximate a Gaussian kernel. Every task adds up the normal equations of its
training rows, one sum per fold; the sums are a few hundred kilobytes however
many rows there are, and no row is sampled. Solved without a fold, they give
raw scores of rows that the fit has not seen; counts of those scores in
``BINS`` fixed bins are pooled into a non-decreasing calibration. The model
that scores is the one solved on all folds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, table, utf8
from .language_id import held_out
from .packed_sums import merged
from .words import SPACED, cut, hashes, lower, mix, shingles

#: Random features, folds of the calibration, bins of raw scores and their range.
FEATURES = 192
FOLDS = 4
BINS = 4096
LOW, HIGH = -1.0, 2.0
#: Ridge penalty per training row, and its least total.
RIDGE = 1e-4
LEAST_RIDGE = 0.5
#: Kernel width in standard deviations of a statistic, per root of their number.
WIDTH = 1.0
SEED = 11

STATISTICS = (
    "log_words", "log_bytes", "word_length", "word_length_spread", "longest_word", "distinct_words", "top_word",
    "distinct_shingles", "lines_per_word", "distinct_lines", "capitals", "digits", "wide", "separators", "symbols",
    "punctuation", "stops", "commas", "wordless",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_CLASSES = {
    "capitals": _class(bytes(range(65, 91))),
    "digits": _class(b"0123456789"),
    "wide": (np.arange(256) >= 0xC0).astype(np.uint8),  # first bytes of characters beyond ASCII
    "separators": (~SPACED).astype(np.uint8),
    "symbols": _class(b"#$%&*|<>{}[]\\^~@=_+"),
    "punctuation": _class(bytes(c for c in range(33, 127) if not chr(c).isalnum())),
    "stops": _class(b".!?"),
    "commas": _class(b",;:"),
}
_LETTER = (np.isin(np.arange(256), [*range(65, 91), *range(97, 123)]) | (np.arange(256) >= 0x80)).astype(np.uint8)
_LINE = np.ones(256, bool)
_LINE[10] = False


def _per(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``x`` between consecutive offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[off])


def _distinct(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each run of ``h``, and how often the most frequent one occurs."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    order = np.lexsort((h, owner))
    o, v = owner[order], h[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(v)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, o[at], runs)
    return np.bincount(o[at], minlength=n), top


def statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """``(texts, STATISTICS)`` of UTF-8 texts; all of an empty text's are 0."""
    n = len(off) - 1
    size = np.diff(off)
    starts, ends, first = cut(raw, off, SPACED)
    count = np.diff(first)
    words, chars = np.maximum(count, 1), np.maximum(size, 1)
    length = ends - starts
    h = hashes(lower(raw), starts, ends)
    mean = _per(length, first) / words
    spread = np.sqrt(np.maximum(_per(length * length, first) / words - mean**2, 0))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, np.repeat(np.arange(n), count), length)
    distinct, top = _distinct(h, first)
    sh, bounds = shingles(h, first, 3)
    per_text = np.maximum(np.diff(bounds), 1)
    ls, le, lfirst = cut(raw, off, _LINE)
    lines = np.diff(lfirst)
    line_words = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    line_hash = _line_hashes(h, *line_words)
    lettered = np.concatenate([[0], np.cumsum(_LETTER[raw], dtype=np.int64)])
    wordless = _per((lettered[ends] == lettered[starts]).astype(np.int64), first)
    share = {k: _per(lut[raw], off) / chars for k, lut in _CLASSES.items()}
    table_ = {
        "log_words": np.log1p(count), "log_bytes": np.log1p(size), "word_length": mean, "word_length_spread": spread,
        "longest_word": np.log1p(longest), "distinct_words": distinct / words, "top_word": top / words,
        "distinct_shingles": _distinct(sh, bounds)[0] / per_text, "lines_per_word": lines / words,
        "distinct_lines": _distinct(line_hash, lfirst)[0] / np.maximum(lines, 1), "wordless": wordless / words, **share,
    }
    return np.stack([table_[k] for k in STATISTICS], axis=1).astype(float) if n else np.zeros((0, len(STATISTICS)))


def _line_hashes(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of the words ``lo:hi`` of each line, in order."""
    n = hi - lo
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    terms = mix(h[np.repeat(lo, n) + at] + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    end = np.cumsum(n)
    return mix(total[end] - total[end - n] + n.astype(np.uint64))


class QualityModel:
    """Standardisation, random projections, ridge weights and calibration; a few hundred kilobytes."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, seed: int = SEED):
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        rng = np.random.default_rng(seed)
        width = WIDTH * np.sqrt(len(mean))
        self.w = rng.normal(0, 1 / width, (len(mean), features))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)
        self.knots, self.values = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of statistics, and a constant."""
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        f = np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.concatenate([f, np.ones((len(f), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores, 0 to 1."""
        return np.clip(np.interp(self.features(x) @ self.beta, self.knots, self.values), 0, 1)


def solve(a: np.ndarray, b: np.ndarray, n: float) -> np.ndarray:
    """Ridge weights from summed normal equations of ``n`` rows; the constant, last, is not penalised."""
    penalty = np.full(len(b), max(RIDGE * n, LEAST_RIDGE))
    penalty[-1] = 1e-9
    return np.linalg.lstsq(a + np.diag(penalty), b, rcond=None)[0]


def isotonic(x: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing values that fit the shares ``positives / counts`` of ascending ``x`` (pool adjacent violators).

    Each pool counts one positive and one negative row more, so that no score is quite 0 or 1.
    """
    pools: list[list[float]] = []
    for v, p, c in zip(x, positives, counts):
        pools.append([v * c, p, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [s + t for s, t in zip(pools[-1], last)]
    # the correction of small pools must not break the order
    values = np.maximum.accumulate([(p + 1) / (c + 2) for _, p, c in pools])
    return np.array([s / c for s, _, c in pools]), values


def _sums(model):
    """Per task and fold: the normal equations of its rows, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        d = len(m.beta)
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.array(batch.column("x").flatten()).reshape(-1, len(STATISTICS))
            y, fold = np.array(batch.column("y"), float), np.array(batch.column("fold"))
            f = m.features(x)
            for k in np.unique(fold):
                g, t = f[fold == k], y[fold == k]
                total = sums.setdefault(int(k), np.zeros(d * d + d + 1))
                total[: d * d] += (g.T @ g).ravel()
                total[d * d : -1] += g.T @ t
                total[-1] += len(t)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["key", "payload"]
            )

    return run


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + b


def _binned(model, betas):
    """Per task: rows and positives of every bin of raw scores, each row scored by the weights of its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, weights = model.value, betas
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            x = np.array(batch.column("x").flatten()).reshape(-1, len(STATISTICS))
            y, fold = np.array(batch.column("y"), np.int64), np.array(batch.column("fold"))
            raw = (m.features(x) * weights[fold]).sum(axis=1)
            at = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
            counts += np.stack([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS).astype(np.int64)])
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[0][at]), pa.array(counts[1][at])], ["bin", "n", "p"])

    return run


def fit(rows: DataFrame) -> QualityModel:
    """Train on all ``rows (x array<double>, y 0 or 1, fold)``; without rows every score is 0.5.

    The driver holds the folds' normal equations and the counts of the bins, never a row.
    """
    spark = rows.sparkSession
    d = len(STATISTICS)
    moments = rows.agg(*[f(F.get("x", F.lit(i))) for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    if moments[0] is None:
        return QualityModel(np.zeros(d), np.ones(d))
    model = QualityModel(np.array(moments[0::2], float), np.array(moments[1::2], float))
    shared = spark.sparkContext.broadcast(model)
    partials = rows.mapInArrow(_sums(shared), "key int, payload binary")
    total = merged(partials, _add, lambda p: np.frombuffer(p).copy(), lambda v: v.tobytes(), "int").collect()  # one row per fold
    sums = {r["key"]: np.frombuffer(r["payload"]) for r in total}
    size = len(model.beta)
    unpack = lambda t: (t[: size * size].reshape(size, size), t[size * size : -1], t[-1])
    everything = sum(sums.values())
    betas = np.zeros((FOLDS, size))
    for k, t in sums.items():
        betas[k] = solve(*unpack(everything - t if len(sums) > 1 else everything))
    found = rows.mapInArrow(_binned(shared, betas), "bin int, n long, p long").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    bins = np.array([tuple(r) for r in found.collect()], float)  # at most BINS rows
    bins = bins[np.argsort(bins[:, 0])]
    model.beta = solve(*unpack(everything))
    model.knots, model.values = isotonic(LOW + (bins[:, 0] + 0.5) / BINS * (HIGH - LOW), bins[:, 2], bins[:, 1])
    return model


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(*utf8(batch.column("text")))
        values = pa.array(x.ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(STATISTICS)), pa.int32()), values)
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "x"])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            x = np.array(batch.column("x").flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(m.score(x))], ["id", "score"])

    return run


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, x)``: the statistics of every whole text, written once to the shared folder; a null text reads as empty."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return materialize(rows.mapInArrow(_statistics, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>"), "statistics")


def training_rows(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """``(x, y, fold)`` of the labelled rows of ``stats`` that are not held out.

    Labels other than 0 and 1 are unused; of several of one id the largest
    counts, which leaves one label per id. Rows that share an id all count.
    """
    known = labels.where(F.col(label).isin(0, 1)).where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = known.where(~held_out("id"))
    return stats.join(known, "id").select("x", "y", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int").alias("fold"))


def classify(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``(id, score)`` of every row of :func:`document_statistics`."""
    kind = stats.schema["id"].dataType.simpleString()
    return stats.mapInArrow(_scored(stats.sparkSession.sparkContext.broadcast(model)), f"id {kind}, score double")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of those that are not held out."""
    stats = document_statistics(table(spark, sf_dir, "documents"))
    model = fit(materialize(training_rows(stats, table(spark, sf_dir, "labels")), "training"))
    out = classify(stats, model)
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
